"""MinHash near-duplicates by an LSH forest: neighbours in several sorted signature orders, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, checked, connected_components, mix64, settle, shuffle_partitions
from rastercube.llm.ranking import ranked

# Sorted orders, values in each order's key, values that neighbours must share at least, neighbours on either side.
TREES, DEPTH, LEAST, NEAR = 16, 8, 3, 16
# Rows of an order that a task holds at once, shingles hashed at a time.
BLOCK_ROWS, STEP = 8192, 2048
# Rows and shingles of a large region's part, which meets another one in a task, and how many of its rows do at once.
PART_ROWS, PART_SHINGLES, LINES = 2048, 2_000_000, 256
# Pairs whose signatures are compared at once; shingles that are looked up at once.
PAIRS, SIDE = 65_536, 1_000_000
MARKS = "row long, doc_id long, mark long, n_shingles long, digest binary, keys binary, bits binary"
_SEEDS = mix64(np.arange(TREES * DEPTH, dtype=np.uint64), 7).astype(np.uint32)


def shingle_set(text: bytes, words: int = 5) -> np.ndarray:
    """The 64-bit hashes of a text's distinct word shingles in ascending order (ASCII lower case).

    A text with fewer words has their whole sequence as its one shingle, one
    without words none.
    """
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(found))
    hashed = xxhash.xxh3_64_intdigest
    spans = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1:].tolist())
    return np.unique(np.fromiter((hashed(joined[a:b]) for a, b in spans), np.uint64, len(found) - k + 1))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` MinHash values of 16 bits: the lower half of the least scrambled 32-bit shingle hash.

    (The upper half of a least value is near zero in long texts and would tell little.)
    """
    least = np.full(len(_SEEDS), 0xFFFFFFFF, np.uint32)
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for i in range(0, len(x), STEP):
        h = x[None, i: i + STEP] ^ _SEEDS[:, None]
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
        np.minimum(least, h.min(axis=1), out=least)
    return least.astype(np.uint16)


def _mark(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Sizes and digests of the sets and, in big-endian bytes so that they sort like the values, the orders' keys."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            sets = [shingle_set(t or b"", words) for t in byte_values(part.column(3))]
            signed = [signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                *part.columns[:3], pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array([s.astype(">u2").tobytes() for s in signed], pa.binary()),
                pa.array([np.packbits(s & 1).tobytes() for s in signed], pa.binary())],
                names=["row", "doc_id", "mark", "n_shingles", "digest", "keys", "bits"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sets = [shingle_set(t or b"", words).tobytes() for t in byte_values(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])


def full_sets(texts: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``(node, shingles)`` of the classes ``(node, doc_id, mark)``, from one document ``(doc_id, mark, text)`` of each."""
    wanted = checked(nodes.toDF("node", "d", "m"))
    found = texts.join(wanted, (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d")))
    found = found.select("node", "text").dropDuplicates(["node"])
    return found.mapInArrow(partial(_sets, words=words), "node long, shingles binary")


def alike_bits(percent: int) -> int:
    """How many of the signature values' last bits must agree: nine standard deviations below what a link has.

    Those of equal values agree, of the others every second, so of a pair at
    0.85 118 of 128 do; it has less than 92 once in 3e10.
    """
    n, p = TREES * DEPTH, (1 + percent / 100) / 2
    return int(n * p - 9 * (n * p * (1 - p)) ** 0.5)


def _run_sizes(block: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each row and depth the number of neighbouring rows of its block that share so many values."""
    sizes = np.empty((DEPTH + 1, len(block)), np.int64)
    differ = np.concatenate(([True], block[1:] != block[:-1]))
    for depth in range(DEPTH + 1):
        if depth:
            differ[1:] |= key[1:, depth - 1] != key[:-1, depth - 1]
        head = np.flatnonzero(differ)
        size = np.diff(np.append(head, len(block)))
        sizes[depth] = np.repeat(size, size)
    return sizes


def _neighbours(batches: Iterator[pa.RecordBatch], near: int, least: int, percent: int) -> Iterator[pa.RecordBatch]:
    """``(u, v, shared)`` for the neighbours in the blocks of a partition sorted by (block, place)."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("shared", pa.int32())])
    apart = TREES * DEPTH - alike_bits(percent)

    def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
        block, place, node, size = (t.column(x).to_numpy() for x in ("block", "place", "node", "n_shingles"))
        bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(len(block), -1)
        key = np.frombuffer(b"".join(t.column("key").to_pylist()), ">u2").reshape(len(block), DEPTH)
        runs = _run_sizes(block, key)
        at = np.arange(len(block) - 1)
        for step in range(1, near + 1):
            at = at[at + step < len(block)]
            # rows of the block's overlap with the next one come first again there
            ok = (block[at] == block[at + step]) & (place[at] < BLOCK_ROWS)
            at = at[ok & (key[at, :least] == key[at + step, :least]).all(axis=1)]
            if not len(at):
                break
            same = key[at] == key[at + step]
            shared = np.where(same.all(axis=1), DEPTH, np.argmin(same, axis=1))
            fit = 100 * np.minimum(size[at], size[at + step]) >= percent * np.maximum(size[at], size[at + step])
            fit &= np.bitwise_count(bits[at] ^ bits[at + step]).sum(axis=1) <= apart
            if step > 1:
                fit &= runs[shared, at] <= near + 1
            a, b = node[at[fit]], node[at[fit] + step]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)),
                                              pa.array(shared[fit].astype(np.int32))], schema=schema)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < 4 * BLOCK_ROWS:
            continue
        table = pa.Table.from_batches(held)
        block = table.column("block").to_numpy()
        cut = int(np.searchsorted(block, block[-1]))
        if cut:
            yield from pairs(table.slice(0, cut))
            held, rows = table.slice(cut).combine_chunks().to_batches(), rows - cut
    if rows:
        yield from pairs(pa.Table.from_batches(held))


def candidates(classes: DataFrame, percent: int, near: int = NEAR, least: int = LEAST) -> DataFrame:
    """Distinct pairs ``(u, v, shared)`` of the ``(node, n_shingles, keys, bits)`` classes that are neighbours in some order.

    Each order sorts the classes by its own ``DEPTH`` signature values, so that
    neighbours have the longest common prefix, and regions are runs of rows
    with the same first values, ``least`` at least.  A region of up to ``near``
    + 1 rows is searched whole; in a larger one the depth grows until its parts
    are that small, and of what lies between these parts, or cannot be parted,
    each row only meets the next one here, and :func:`region_links` finds the rest.  Pairs whose sizes
    cannot fit, or whose signatures are clearly apart, are left out.  The orders are cut
    into blocks of a fixed number of rows, each with the first rows of the next.
    """
    width = 2 * DEPTH
    keyed = classes.select("node", "n_shingles", "keys", "bits", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "tree", F.substring(F.col("keys"), F.col("tree") * width + 1, F.lit(width)).alias("key"), "node", "n_shingles", "bits")
    placed = ranked(keyed, "tree", ["key", "node"])
    part, place = F.floor(F.col("rank") / BLOCK_ROWS), (F.col("rank") % BLOCK_ROWS).cast("int")
    # a number for each order's blocks, one after another
    block = part * TREES + F.col("tree")
    own = F.struct(block.alias("block"), place.alias("place"))
    before = F.struct((block - TREES).alias("block"), (place + BLOCK_ROWS).alias("place"))
    placed = placed.select("key", "node", "n_shingles", "bits", F.explode(
        F.when((place < near) & (part > 0), F.array(own, before)).otherwise(F.array(own))).alias("p"))
    laid = placed.select("p.*", "key", "node", "n_shingles", "bits").repartition(
        shuffle_partitions(classes), "block").sortWithinPartitions("block", "place")
    found = laid.mapInArrow(partial(_neighbours, near=near, least=least, percent=percent), "u long, v long, shared int")
    return found.groupBy("u", "v").agg(F.max("shared").alias("shared"))


def alike_values(percent: int) -> int:
    """How many signature values must agree: nine standard deviations below what a link has."""
    n, p = TREES * DEPTH, percent / 100
    return int(n * p - 9 * (n * p * (1 - p)) ** 0.5)


def _meet(t: pa.Table, percent: int, least: int) -> Iterator[tuple[int, int]]:
    """Linked pairs ``(u, v)`` of two parts (or of one) of a region, one for each two components that they join.

    Pairs of rows of different components are compared by size and signature
    and then by their full sets.  A pair that shares regions in several orders
    is the first one's.
    """
    tree, one, two = (t.column(c)[0].as_py() for c in ("tree", "i", "j"))
    part, node, size, label = (t.column(c).to_numpy() for c in ("part", "node", "n_shingles", "root"))
    bits = np.frombuffer(b"".join(t.column("bits").to_pylist()), np.uint64).reshape(len(part), -1)
    signed = np.frombuffer(b"".join(t.column("keys").to_pylist()), ">u2").astype(np.uint16).reshape(len(part), -1)
    values, word = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]), return_inverse=True)
    label, first = label.copy(), np.cumsum(size) - size
    apart, agree = TREES * DEPTH - alike_bits(percent), alike_values(percent)
    mark = np.zeros(len(values), bool)
    left, right = np.flatnonzero(part == one), np.flatnonzero(part == two)
    for at in range(0, len(left), LINES):
        a = left[at: at + LINES, None]
        fit = label[a] != label[right]
        if one == two:
            fit &= a < right
        fit &= 100 * np.minimum(size[a], size[right]) >= percent * np.maximum(size[a], size[right])
        x, y = np.nonzero(fit)
        x, y = left[at + x], right[y]
        keep = np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1) <= apart
        x, y = x[keep], y[keep]
        for k in range(0, len(x), PAIRS):
            same = signed[x[k: k + PAIRS]] == signed[y[k: k + PAIRS]]
            earlier = same.reshape(-1, TREES, DEPTH)[:, :tree, :least].all(axis=2).any(axis=1)
            keep[k: k + PAIRS][: len(same)] = (same.sum(axis=1) >= agree) & ~earlier
        x, y = x[keep[: len(x)]], y[keep[: len(x)]]
        for u, others in zip(*_runs(x, y)):
            others = others[label[others] != label[u]]
            mine = word[first[u]: first[u] + size[u]]
            mark[mine] = True
            # at most so many shingles are laid side by side
            for v in np.split(others, np.flatnonzero(np.diff(np.cumsum(size[others]) // SIDE)) + 1) if len(others) else ():
                n = size[v]
                head = np.cumsum(n) - n
                shared = np.add.reduceat(mark[word[np.repeat(first[v] - head, n) + np.arange(n.sum())]].astype(np.int64), head)
                for w in v[100 * shared >= percent * (size[u] + n - shared)].tolist():
                    if label[w] != label[u]:
                        label[label == label[w]] = label[u]
                        yield (node[u], node[w])
            mark[mine] = False


def _runs(x: np.ndarray, y: np.ndarray) -> tuple[list, list]:
    """The values of ``x``, which is sorted, and the ``y`` of each."""
    value, at = np.unique(x, return_index=True)
    return value.tolist(), np.split(y, at[1:]) if len(value) else []


def _region(batches: Iterator[pa.RecordBatch], percent: int, least: int) -> Iterator[pa.RecordBatch]:
    """:func:`_meet` for each (tree, key, i, j) of a partition that is sorted by them."""
    def links(t: pa.Table) -> pa.RecordBatch:
        found = np.array(list(_meet(t, percent, least)), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        for c in ("tree", "key", "i", "j"):
            x = batch.column(c).to_numpy(zero_copy_only=False)
            new[1:] |= x[1:] != x[:-1]
            new[0] |= not held or x[0] != held[-1].column(c)[-1].as_py()
        edges = [*np.flatnonzero(new).tolist(), batch.num_rows]
        if edges[0]:
            held.append(batch.slice(0, edges[0]))
        for a, b in zip(edges, edges[1:]):
            if held:
                yield links(pa.Table.from_batches(held))
            held = [batch.slice(a, b - a)]
    if held:
        yield links(pa.Table.from_batches(held))


def region_links(classes: DataFrame, roots: DataFrame, texts: DataFrame, words: int, percent: int,
                 near: int = NEAR, least: int = LEAST) -> DataFrame | None:
    """Links ``(u, v)`` that join all components which pairs in regions of more than ``near`` + 1 rows join; no such region: None.

    Regions inside one component, as most groups of near copies are, are left
    out.  The others' rows are dealt, with their full sets, into parts of about ``PART_ROWS``
    rows and ``PART_SHINGLES`` shingles, and every two parts meet in a task,
    so that no region is gathered.  A set is moved once for each part of its
    regions, not for each pair, and no pairs leave the task but links between different components.
    """
    rooted = classes.join(checked(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    keyed = settle(rooted.select("node", "n_shingles", "root", F.posexplode(F.array(*[
        F.substring("keys", 2 * DEPTH * tree + 1, 2 * least) for tree in range(TREES)])).alias("tree", "key")))
    parts = F.ceil(F.greatest(F.col("n") / PART_ROWS, F.col("all") / PART_SHINGLES))
    large = settle(keyed.groupBy("tree", "key").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("all"), F.min("root").alias("a"), F.max("root").alias("b")).where(
        (F.col("n") > near + 1) & (F.col("a") < F.col("b"))).select("tree", "key", parts.alias("parts")))
    if not large.limit(1).count():
        return None
    held = settle(keyed.join(checked(large), ["tree", "key"]).drop("n_shingles"))
    inside = classes.join(checked(held.select("node").distinct()), "node", "left_semi")
    sets = full_sets(texts, inside.select("node", "first.doc_id", "first.mark"), words)
    whole = settle(inside.select("node", "n_shingles", "keys", "bits").join(sets, "node"))
    held = held.withColumn("part", F.pmod(F.xxhash64("node"), "parts")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    met = held.select("tree", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "root")
    met = met.join(whole, "node").repartition(shuffle_partitions(classes), "tree", "key", "i", "j").sortWithinPartitions("tree", "key", "i", "j")
    return met.mapInArrow(partial(_region, percent=percent, least=least), "u long, v long")


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets, as sorted hashes, are alike enough."""
    for batch in batches:
        keep = []
        for i in range(batch.num_rows):
            a, b = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
            both = np.concatenate((a, b))
            both.sort(kind="stable")
            shared = int(np.count_nonzero(both[1:] == both[:-1]))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                keep.append(i)
        yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], names=["u", "v"])


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose full sets have ``100 * intersection >= percent * union``; ``sets`` has (node, shingles)."""
    met = sets.toDF("u", "a").join(checked(pairs.select("u", "v")), "u").join(sets.toDF("v", "b"), "v")
    return met.select("u", "v", "a", "b").mapInArrow(partial(_confirm, percent=percent), "u long, v long")


def _crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs between different components; a node without a row in ``roots`` is its own."""
    both = pairs.join(checked(roots.toDF("u", "ru")), "u", "left").join(checked(roots.toDF("v", "rv")), "v", "left")
    return both.where(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select(*pairs.columns)


def _nearest(pairs: DataFrame) -> DataFrame:
    """For each node the pair of the longest shared prefix."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node"), "u", "v", "shared")
    best = ends.groupBy("node").agg(F.max(F.struct("shared", "u", "v")).alias("p"))
    return best.select("p.u", "p.v").distinct()


def components(classes: DataFrame, texts: DataFrame, words: int, percent: int, rounds: int = 2) -> DataFrame:
    """``(node, root)`` of the classes that are linked with others.

    A candidate inside a component need not be confirmed any more.  So first
    each class's nearest candidate is, ``rounds`` times over, and the classes
    found to be linked are joined; last, all candidates that still lie between
    different components are confirmed, and what :func:`candidates` left out
    in large regions is met there.  Only sets of classes with a candidate
    of a fitting size, or in such a region, are made and moved.
    """
    def sets_of(pairs: DataFrame) -> DataFrame:
        needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        return settle(full_sets(texts, classes.join(needed, "node").select("node", "first.doc_id", "first.mark"), words))

    open_pairs = settle(candidates(classes, percent))
    sets = sets_of(open_pairs)
    found = roots = None
    for _ in range(max(rounds, 1)):
        tested = settle(_nearest(open_pairs))
        new = settle(links(tested, sets, percent))
        found = new if found is None else settle(found.unionByName(new))
        roots = settle(connected_components(found))
        rest = open_pairs.join(tested.select("u", "v"), ["u", "v"], "left_anti")
        open_pairs = settle(_crossing(rest, roots))
        more = open_pairs.limit(1).count()
        if not more:
            break
    last = [settle(links(open_pairs, sets, percent))] if more else []
    inside = region_links(classes, roots, texts, words, percent)
    last += [] if inside is None else [settle(inside)]
    if any([x.limit(1).count() for x in last]):
        roots = settle(connected_components(reduce(DataFrame.unionByName, last, found)))
    return roots


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id (least doc_id reachable), kept (doc_id = component_id).

    Documents are linked if their sets of word shingles have ``100 *
    intersection >= percent * union``; sets are hashes of 64 bits a shingle.
    Equal sets are one class and linked at once.  Classes are candidates as
    :func:`candidates` and :func:`region_links` say: a pair at 0.85 shares no
    region, and is missed, with a probability of (1 - 0.85 ** 3) ** 16, about
    2e-7, and every candidate that could join two components is confirmed.

    Null and empty texts, and those without words, have no shingles and are
    linked with nothing.  A null id is a component's name only if all its ids
    are null; its rows are kept then.  Repeated rows come back as often as they went in; an empty table
    gives none; other columns are left out.
    """
    if words < 1 or not 0 < percent <= 100:
        raise ValueError("words must be positive, percent between 1 and 100")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    marked = settle(texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "mark", "text").mapInArrow(
        partial(_mark, words=words), MARKS))
    classes = settle(marked.where("n_shingles > 0").groupBy("digest").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("n"),
        F.min(F.struct("row", "doc_id", "mark")).alias("first"),
        F.any_value("n_shingles").alias("n_shingles"), F.any_value("keys").alias("keys"),
        F.any_value("bits").alias("bits")))
    roots = components(classes.select("node", "n_shingles", "keys", "bits", "first"), texts, words, percent)
    rooted = classes.select("digest", "node", "least", "n").join(roots, "node", "left")
    ids = rooted.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    shared = settle(rooted.where("root is not null or n > 1").join(ids, "root", "left").select(
        "digest", F.coalesce("component", "least").alias("component_id"), F.lit(True).alias("together")))
    out = marked.select("doc_id", "n_shingles", "digest").join(checked(shared), "digest", "left")
    component = F.when(F.col("together") & (F.col("n_shingles") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
