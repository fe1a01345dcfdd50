"""Morton keys of pixels, and boxes as ranges of keys that reach the Parquet scan."""

from __future__ import annotations

import heapq
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY = "z"
BITS = 31  # of a coordinate: keys fit into a signed long
MAX_RANGES = 64
# How far bits are moved apart in each step, and the bits kept then.
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
          (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(x: Column) -> Column:
    x = x.cast("long")
    for shift, mask in SPREAD:
        x = F.shiftleft(x, shift).bitwiseOR(x).bitwiseAND(F.lit(mask))
    return x


def morton_key(row: str | Column = "row", col: str | Column = "col") -> Column:
    """The bits of ``row`` and ``col`` in turns, ``row``'s first: near pixels mostly have near keys.

    Coordinates are at least 0 (smaller ones, which no tile has, count as 0);
    a null coordinate gives a null key.
    """
    row, col = (F.when(c >= 0, c).when(c < 0, 0) for c in (F.col(x) if isinstance(x, str) else x for x in (row, col)))
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(col))


def key_ranges(boxes: Iterable[tuple[int, int, int, int]], most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges of keys, in order, that hold every pixel of the inclusive boxes (row, row, col, col).

    Squares of the key's quadtree are quartered, the largest first, until they
    lie inside a box or there are enough of them; then the ranges with the
    smallest gaps between them are joined.  A range may hold other pixels as
    well: the box test stays.
    """
    boxes = [(max(0, a), b, max(0, c), d) for a, b, c, d in boxes]
    boxes = [x for x in boxes if x[0] <= x[1] and x[2] <= x[3]]
    if not boxes:
        return []
    top = max(max(b, d) for _, b, _, d in boxes).bit_length()
    # a square: (-side in bits, first key, first row, first column, the boxes that it meets)
    whole, open_squares = [], [(-top, 0, 0, 0, boxes)]
    while open_squares and len(open_squares) + len(whole) < 4 * most:
        bits, key, row, col, near = heapq.heappop(open_squares)
        half, bits = 1 << max(0, -bits - 1), -bits
        if bits == 0:
            whole.append((key, key))
            continue
        for i in range(4):
            r, c, k = row + (i >> 1) * half, col + (i & 1) * half, key + i * half * half
            met = [x for x in near if x[0] < r + half and x[1] >= r and x[2] < c + half and x[3] >= c]
            if any(x[0] <= r and x[1] >= r + half - 1 and x[2] <= c and x[3] >= c + half - 1 for x in met):
                whole.append((k, k + half * half - 1))
            elif met:
                heapq.heappush(open_squares, (1 - bits, k, r, c, met))
    ranges = sorted(whole + [(k, k + (1 << 2 * -b) - 1) for b, k, *_ in open_squares])
    gaps = sorted((b[0] - a[1] for a, b in zip(ranges, ranges[1:])), reverse=True)
    widest = gaps[most - 2] if 1 < most <= len(gaps) else 1
    out = [list(ranges[0])]
    for lo, hi in ranges[1:]:
        if lo - out[-1][1] > 1 and lo - out[-1][1] >= widest and len(out) < most:
            out.append([lo, hi])
        else:
            out[-1][1] = max(out[-1][1], hi)
    return [(a, b) for a, b in out]


def in_ranges(ranges: list[tuple[int, int]], key: str = KEY) -> Column:
    """A filter on the key that Parquet row groups and pages are tested by."""
    tests = [F.col(key).between(F.lit(a).cast("long"), F.lit(b).cast("long")) for a, b in ranges]
    while len(tests) > 1:  # a balanced tree: the depth of an expression is bounded
        tests = [reduce(lambda x, y: x | y, tests[i:i + 2]) for i in range(0, len(tests), 2)]
    return tests[0] if tests else F.lit(False)
