"""SimHash near-duplicates by a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, checked, connected_components, settle, shuffle_partitions

BITS, FANOUT = 64, 8
# Expected members of a key's group, from which a finer key is taken; members from which a key is split; pairs at a time.
GROUP_ROWS, SPLIT_ROWS, PAIRS = 512, 100_000, 200_000


def fingerprint(text: bytes, words: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles (ASCII lower case, XXH64 with seed 42)."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(found))
    spans = list(zip(starts[: len(found) - k + 1].tolist(), ends[k - 1:].tolist()))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(spans), 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans[i: i + (1 << 16)]], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_sha256, fp)`` for each row, ``fp`` as a signed long; a null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t or b"", words) for t in byte_values(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fps.view(np.int64))], schema=schema)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long"), F.sha2(text, 256), text).mapInArrow(
        run, "doc_id long, text_sha256 string, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _union(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the sets of each ``u`` and ``v``; afterwards every entry names its set's least member."""
    while len(u):
        a, b = parent[u], parent[v]
        differ = a != b
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def index_links(group: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """For each code the position of the least one that it reaches within its group over distances <= ``max_bits``.

    ``group`` is sorted; the codes of a group must be in Gray order.  Upper
    nodes factor out the bit pattern that up to ``FANOUT`` neighbours share:
    a node keeps the AND and OR of its codes, so the set bits are shared where
    AND holds them and the clear ones where OR lacks them.  A pair of nodes is
    dropped when their shared bits alone differ in more than ``max_bits``
    places, linked as a whole when no two codes below can differ more, and
    left out when all below are linked already; else its children are paired.
    """
    n = len(fp)
    ands, ors, groups, begins, firsts = [fp], [fp], [group], [], [np.arange(n)]
    while True:
        g = groups[-1]
        head = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        if len(head) == len(g):
            break
        inside = np.arange(len(g)) - np.repeat(head, np.diff(np.append(head, len(g))))
        at = np.flatnonzero(inside % FANOUT == 0)
        begins.append(np.append(at, len(g)))
        ands.append(np.bitwise_and.reduceat(ands[-1], at))
        ors.append(np.bitwise_or.reduceat(ors[-1], at))
        groups.append(g[at])
        firsts.append(firsts[-1][at])
    parent, top = np.arange(n), len(begins)
    grid_a, grid_b = (x.ravel() for x in np.meshgrid(np.arange(FANOUT), np.arange(FANOUT), indexing="ij"))
    stack = [(top, np.arange(len(groups[top])), np.arange(len(groups[top])))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS // (1 if level == 0 else FANOUT * FANOUT):
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        both, some = ands[level][a] & ands[level][b], ors[level][a] | ors[level][b]
        apart = (ands[level][a] & ~ors[level][b]) | (ands[level][b] & ~ors[level][a])
        near = np.bitwise_count(apart) <= max_bits
        if level == 0:
            _union(parent, a[near], b[near])
            continue
        low, high = np.minimum.reduceat(parent, firsts[level]), np.maximum.reduceat(parent, firsts[level])
        near &= ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
        whole = near & (np.bitwise_count(some & ~both) <= max_bits)
        if whole.any():
            edge = np.append(firsts[level], n)
            node = np.unique(np.concatenate((a[whole], b[whole])))
            size = edge[node + 1] - edge[node]
            member = np.repeat(edge[node] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            _union(parent, member, np.repeat(edge[node], size))
            _union(parent, edge[a[whole]], edge[b[whole]])
            near &= ~whole
        a, b = a[near], b[near]
        if not len(a):
            continue
        starts = begins[level - 1]
        ca, cb = starts[a][:, None] + grid_a, starts[b][:, None] + grid_b
        real = (ca < starts[a + 1][:, None]) & (cb < starts[b + 1][:, None])
        # one half of a node's pairs with itself; at the bottom, no code with itself
        real &= (a != b)[:, None] | (ca < cb if level == 1 else ca <= cb)
        stack.append((level - 1, ca[real], cb[real]))
    return parent


def _bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int, masks: list[int]) -> Iterator[pa.RecordBatch]:
    """Edges within the groups of a partition sorted by (c, key, i, j); a group is held whole (its size is bounded)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    free = ~np.array(masks, np.uint64)

    def links(t: pa.Table) -> pa.RecordBatch:
        cols = [t.column(x).to_numpy() for x in ("c", "key", "i", "j")]
        fp = t.column("fp").to_numpy().view(np.uint64)
        order = np.lexsort((gray_rank(fp & free[cols[0]]), *reversed(cols)))
        fp = fp[order]
        new = np.zeros(len(fp), bool)
        for x in cols:
            x = x[order]
            new[1:] |= x[1:] != x[:-1]
        parent = index_links(np.cumsum(new), fp, max_bits)
        member = np.flatnonzero(parent != np.arange(len(fp)))
        member = member[fp[member] != fp[parent[member]]]
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[x].view(np.int64)) for x in (member, parent[member])], schema=schema)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < SPLIT_ROWS:
            continue
        table = pa.Table.from_batches(held)
        last = np.ones(rows, bool)
        for x in ("c", "key", "i", "j"):
            col = table.column(x).to_numpy()
            last &= col == col[-1]
        cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
        if cut:
            yield links(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            rows -= cut
    if rows:
        yield links(pa.Table.from_batches(held))


def segment_masks(n: int, max_bits: int) -> list[int]:
    """Bit masks of which any two codes within ``max_bits`` agree on at least one.

    The 64 bits are cut into m segments; ``max_bits`` differences leave m -
    max_bits of them whole, so all choices of so many segments are the masks.
    m grows with the number of codes ``n``, which keeps groups small; every
    choice finds the same pairs.
    """
    m = max_bits + 1
    while n >> (BITS * (m - max_bits) // m) > GROUP_ROWS and m < max_bits + 4:
        m += 1
    edges = [BITS * i // m for i in range(m + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(part, m - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(codes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Edges ``(u, v)`` of a forest for each masked pattern, over distinct ``fp`` codes: exact at any size.

    Codes are grouped by each mask of :func:`segment_masks` (the index's
    topmost nodes) and each group is searched by :func:`index_links`.  A
    pattern of more than ``SPLIT_ROWS`` codes is split into blocks, and each
    pair of blocks becomes a group of its own.
    """
    masks = segment_masks(codes.count(), max_bits)
    keyed = codes.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("c", "key"))
    hot = settle(keyed.groupBy("c", "key").count().where(F.col("count") > SPLIT_ROWS).select(
        "c", "key", F.ceil(2 * F.col("count") / SPLIT_ROWS).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    keyed = keyed.join(checked(hot), ["c", "key"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    keyed = keyed.withColumn("b", block).withColumn("o", other).select(
        "c", "key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), "fp")
    run = partial(_bucket_links, max_bits=max_bits, masks=masks)
    return (keyed.repartition(shuffle_partitions(codes), "c", "key", "i", "j")
            .sortWithinPartitions("c", "key", "i", "j").mapInArrow(run, "u long, v long"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable), root, text_sha256.

    ``root`` names the component by one of its fingerprints (a signed long).

    Null and empty texts have fingerprint zero and are linked like others;
    equal fingerprints are always linked.  Null ids are never a component's
    name unless all its ids are null.  Repeated rows come back as often as
    they went in; an empty table gives none; other columns are left out.
    """
    if words < 1 or not 0 <= max_bits < BITS // 2:
        raise ValueError("words must be positive, max_bits between 0 and 31")
    marked = settle(fingerprints(docs, words, id_col, text_col))
    codes = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    comps = connected_components(fingerprint_links(codes, max_bits))
    rooted = codes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
    ids = rooted.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    shared = settle(rooted.where("root is not null or n > 1").join(ids, "root", "left").select(
        "fp", F.coalesce("component", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")))
    return marked.join(checked(shared), "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("root", "fp").alias("root"), "text_sha256")
