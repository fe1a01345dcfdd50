"""Minimax contiguous partition of atomic groups into shards, in DataFrame operations only."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import checked, settle

# Hex digits of the first segments of the digest order, digits added by a refinement, rows of a numbering window.
FIRST, MORE, DIGEST, SLOT_ROWS = 3, 2, 64, 20_000


def _segments(groups: DataFrame, prefixes: list[str]) -> list[tuple]:
    """``(prefix, bytes, groups)`` of the segments below ``prefixes`` (equal lengths), in digest order."""
    depth = len(prefixes[0])
    found = groups.where(F.substring("digest", 1, depth).isin(prefixes)) if depth else groups
    deeper = min(depth + MORE, DIGEST) if depth else FIRST
    return [tuple(r) for r in found.groupBy(F.substring("digest", 1, deeper).alias("p")).agg(
        F.sum("bytes"), F.count("*")).orderBy("p").collect()]


def _cuts(ends: list[int], shards: int, capacity: int) -> list[int]:
    """Greedy cut positions: each shard takes segments while their bytes fit; ``ends`` are running sums."""
    cuts, at, base = [], 0, 0
    for _ in range(shards):
        at = max(at, bisect_right(ends, base + capacity))
        cuts.append(at)
        base = ends[at - 1] if at else 0
    return cuts


def _reach(parts: list[tuple], ends: list[int], shards: int, capacity: int) -> tuple[bool, set[int]]:
    """Whether ``shards`` suffice if segments of several groups could be cut anywhere, and the segments so cut."""
    at, inside = 0, set()
    for _ in range(shards):
        i = bisect_right(ends, at + capacity)
        if i == len(parts):
            return True, inside
        start = ends[i - 1] if i else 0
        if parts[i][2] > 1 and at + capacity > start:
            at += capacity
            inside.add(i)
        else:
            at = start
    return False, inside


def _least(fits, low: int, high: int) -> int:
    """The smallest capacity from ``low`` to ``high`` that fits; ``high`` does."""
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def minimax(groups: DataFrame, shards: int, largest: int) -> tuple[list[str | None], int]:
    """``(bounds, capacity)``: the smallest capacity at which greedy cutting needs at most ``shards`` shards.

    Groups are ordered by digest.  The driver holds segments of that order
    with their byte sums, not groups.  A capacity surely does not suffice if
    it does not even where segments may be cut anywhere, and surely does if it
    does with segments as wholes.  Until the least of both kinds is the same,
    only the segments are refined in which a cut falls: at most two a shard
    and round, however large a group is.  ``bounds`` are the digest prefixes
    at which shards 1, 2, ... start (None: such a shard is empty).
    """
    parts = _segments(groups, [""])
    if not parts:
        return [None] * (shards - 1), 0
    total = sum(p[1] for p in parts)
    low = max(largest, -(-total // shards))
    while True:
        ends = list(accumulate(p[1] for p in parts))
        low = _least(lambda c: _reach(parts, ends, shards, c)[0], low, total)
        high = _least(lambda c: _cuts(ends, shards, c)[-1] == len(parts), low, total)
        cuts = _cuts(ends, shards, high)
        if low == high:
            return [parts[c][0] if c < len(parts) else None for c in cuts[:-1]], low
        open_ = _reach(parts, ends, shards, low)[1] | {c for c in cuts if c < len(parts) and parts[c][2] > 1}
        # segments of one depth at a time, the coarsest first
        depth = min(len(parts[i][0]) for i in open_)
        prefixes = [parts[i][0] for i in sorted(open_) if len(parts[i][0]) == depth]
        parts = sorted([p for p in parts if p[0] not in set(prefixes)] + _segments(groups, prefixes))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes plus 1 (null: 1).  Equal texts (by their
    SHA-256; null equals empty) are one atomic group; groups in digest order
    are cut into ``shards`` contiguous runs whose largest is as small as can be
    (:func:`minimax`; law ``bytes``).  The cuts are literals in the plan, so
    assigning rows needs no join, and a huge group does not meet in one task.
    Slots number a shard's rows without gaps: rows are numbered in windows by
    a hash of the row and shifted by the sums of the windows before.

    Repeated rows stay in one shard and get slots of their own, a null id is
    allowed, shards may stay empty if there are too few groups, an empty table
    gives none, and other columns are left out.  ``grown_shard`` is null under
    this law.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = settle(docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest"),
                              F.monotonically_increasing_id().alias("row")))
    groups = settle(rows.groupBy("digest").agg(F.sum("size").alias("bytes")))
    n, largest = rows.count(), groups.agg(F.max("bytes")).first()[0] or 1
    bounds, _ = minimax(groups, shards, largest)
    number = F.lit(0)
    for b in bounds:
        if b is not None:
            number = number + (F.col("digest") >= F.lit(b)).cast("int")
    windows = max(1, n // SLOT_ROWS)
    rows = rows.withColumn("shard", number).withColumn(
        "w", F.pmod(F.xxhash64("row"), F.lit(windows)).cast("int"))
    sums = rows.groupBy("shard", "w").agg(F.count("*").alias("c"))
    before = Window.partitionBy("shard").orderBy("w").rowsBetween(Window.unboundedPreceding, -1)
    sums = settle(sums.select("shard", "w", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip")))
    place = F.row_number().over(Window.partitionBy("shard", "w").orderBy("digest", "doc_id", "row"))
    return rows.withColumn("place", place).join(checked(sums), ["shard", "w"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - 1 + F.col("skip")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
