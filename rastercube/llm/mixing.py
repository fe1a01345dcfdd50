"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import checked, settle, shuffle_partitions

# Draws that an output shard should hold on average, and shards made at least.
SHARD_DRAWS, LEAST_SHARDS = 64, 8
WORD_BREAK = r"[\x20\x09-\x0D]+"


def word_count(text):
    """Words of a text column by the contracts' white space; null has none."""
    return F.coalesce(F.size(F.filter(F.split(text, WORD_BREAK), lambda w: w != "")), F.lit(0)).cast("long")


def water_fill(weight: np.ndarray, cap: np.ndarray, total: float) -> np.ndarray:
    """Shares of ``total`` by weight, none above its cap; excess goes to the others by weight."""
    share, free = np.zeros(len(cap)), np.ones(len(cap), bool)
    while free.any():
        level = max(0.0, total - cap[~free].sum()) / weight[free].sum()
        over = free & (weight * level > cap)
        if not over.any():
            share[free] = weight[free] * level
            break
        free &= ~over
    share[~free] = cap[~free]
    return share


def split_quotas(quota: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first, number)`` of the draws of each source that ``shard`` gets.

    The root holds all quotas; a node over shards lo..hi gives its left half
    as many draws as its shards' even capacities ask for, composed by a
    multivariate hypergeometric draw seeded by the node.  A shard walks its
    own path only, so any task can do it, and quotas are met exactly.
    """
    total, lo, hi = int(quota.sum()), 0, shards
    room = lambda a, b: total * b // shards - total * a // shards
    first, left_over = np.zeros(len(quota), np.int64), quota.astype(np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left, rest, want = np.zeros(len(quota), np.int64), int(left_over.sum()), room(lo, mid)
        for s, have in enumerate(left_over.tolist()):  # the multivariate draw, a source at a time
            rest -= have
            left[s] = _hypergeometric(rng, have, rest, want)
            want -= int(left[s])
        if shard < mid:
            hi, left_over = mid, left
        else:
            lo, first, left_over = mid, first + left, left_over - left
    return first, left_over


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    return int(rng.hypergeometric(good, bad, n)) if n and good else 0


class Mix:
    """A planned mix of ``docs``; :func:`mix` makes it.

    ``sources`` has a row per source (s, source, source_size, target, blocks,
    step, shift), ``draws`` one per drawn block (s, pass, block, room, shard):
    ``block`` is the block's place in its source's permutation, ``room`` the
    words to be taken from a block that is drawn in part.  ``partial`` are the
    documents (s, key, mark) taken from those.
    """

    def __init__(self, docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str):
        self.docs, self.seed, self.cols = docs, seed, (id_col, text_col, source_col)
        # what is needed of each document but its text, counted once
        self.narrow = settle(self._marked().withColumn(
            "size", word_count(F.col(f"doc.{text_col}").cast("string"))).drop("doc"))
        self.sources = self.draws = self.partial = None

    def _marked(self) -> DataFrame:
        """The rows of ``docs`` as struct ``doc``, with doc_id, key (its text form), mark (of the text), u and named."""
        id_col, text_col, source_col = self.cols
        key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
        mark = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        return self.docs.select(
            F.struct(*[self.docs[c] for c in self.docs.columns]).alias("doc"), F.col(id_col).alias("doc_id"),
            key.alias("key"), mark.alias("mark"),
            F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), key, mark), 11).alias("u"),
            F.col(source_col).cast("string").alias("named"))

    def placed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their source's columns and their block."""
        rows = rows.join(checked(self.sources), F.col("named").eqNullSafe(F.col("source"))).drop("named")
        return rows.withColumn("block", F.expr("pmod((pmod(u, blocks) + shift) * step, blocks)")).drop("step", "shift")

    def _position(self, turn):
        """The place of a document's copy of pass ``turn`` in the order of its shard."""
        return F.xxhash64(F.lit(self.seed), F.col("u"), F.col("mark"), turn)

    def accounts(self) -> DataFrame:
        """A row per document: doc_id, size, source, source_size, target, copies, taken, shards, positions.

        ``shards`` has the output shard of each copy in the order of the
        passes, ``positions`` the value that the copy is ordered by in there.
        """
        times = self.draws.groupBy("s", "block").agg(F.sort_array(F.collect_list(F.struct(
            "pass", "shard", F.col("room").isNull().alias("whole")))).alias("times"))
        chosen = self.partial.withColumn("part", F.lit(1))
        known = self.placed(self.narrow).join(checked(settle(times)), ["s", "block"], "left")
        known = known.join(checked(chosen), ["s", "key", "mark"], "left")
        known = known.withColumn("times", F.filter(
            F.coalesce("times", F.array()), lambda x: x["whole"] | F.col("part").isNotNull()))
        copies = F.size("times").cast("long")
        return known.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"),
                            (F.col("size") * copies).alias("taken"),
                            F.transform("times", lambda x: x["shard"]).alias("shards"),
                            F.transform("times", lambda x: self._position(x["pass"])).alias("positions"))

    def documents(self) -> DataFrame:
        """The mix: the columns of ``docs``, a row each time a document is taken, in its shard's shuffled order.

        A shard comes as up to 64 sorted runs, each a range of positions.
        """
        rows = self.placed(self._marked()).join(checked(self.draws), ["s", "block"])
        chosen = self.partial.withColumn("part", F.lit(1))
        rows = rows.join(checked(chosen), ["s", "key", "mark"], "left").where("room is null or part = 1")
        rows = rows.withColumn("position", self._position(F.col("pass")))
        rows = rows.repartition(shuffle_partitions(rows), "shard", F.shiftright("position", 58))
        return rows.sortWithinPartitions("shard", "position").select("doc.*")


def _step(blocks: int, rng: np.random.Generator) -> int:
    """A factor without a divisor in common with ``blocks``, so that multiplying by it permutes them."""
    step = int(rng.integers(blocks)) | 1
    while math.gcd(step, blocks) > 1:
        step += 2
    return step


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7,
        shard_words: int = 50_000_000, least_shards: int = LEAST_SHARDS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        ) -> Mix:
    """Plan a mix of all documents; the result gives the accounts per document and the mixed documents.

    Sources by code point, null last, take ``weights`` in turn and share
    ``share`` of all words; a target stops at ``most`` times its source's size
    (:func:`water_fill`).  The mix goes to one shard for every ``shard_words``
    of it, ``least_shards`` at least.  A source's documents are dealt by a seeded hash of
    id and text into blocks of about a 64th of a shard's words; whole passes and a part of one permutation
    of the blocks are drawn until the target is nearest, the last block only
    up to the document where it is nearest.  :func:`split_quotas` gives each
    output shard an exact number of draws of each source, as a run of that
    source's permuted blocks, disjoint from every other shard's; inside the
    shard, documents are ordered by a seeded hash.

    Null and empty texts have size 0; documents without an id are dealt by
    their texts.  Repeated rows (equal id and text) are taken alike.  An empty
    table gives empty results.  Shards beyond the number of draws stay empty.  Other columns are kept
    by ``documents`` and left out of ``accounts``.  Source totals and the place where a source's
    drawing ends (one row each) are the only things that the driver
    sees; blocks and documents stay distributed.  Reruns agree, however the table is partitioned.
    """
    if not weights or min(weights) <= 0 or share <= 0 or most < share or shard_words < 1 or least_shards < 1:
        raise ValueError("weights, share and shards must be positive and most not below share")
    spark, made = docs.sparkSession, Mix(docs, seed, id_col, text_col, source_col)
    totals = made.narrow.groupBy(F.col("named").alias("source")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    totals = sorted(totals.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    size = np.array([r["size"] for r in totals], float)
    weight = np.array([weights[i % len(weights)] for i in range(len(totals))], float)
    target = water_fill(weight, most * size, share * size.sum())
    shards = max(least_shards, math.ceil(target.sum() / shard_words))
    plan = []
    for i, (r, t) in enumerate(zip(totals, target)):
        n = max(1, min(r["n"], round(SHARD_DRAWS * shards * int(r["size"]) / target.sum()) if target.sum() else 1))
        rng = np.random.default_rng([seed, i])
        plan.append((i, r["source"], int(r["size"]), float(t), n, _step(n, rng), int(rng.integers(n)),
                     int(t // r["size"]) if r["size"] else 0))
    made.sources = spark.createDataFrame(
        [p[:7] for p in plan], "s int, source string, source_size long, target double, blocks long, step long, shift long")
    placed = made.placed(made.narrow)
    blocks = settle(placed.groupBy("s", "block").agg(F.sum("size").alias("words")))
    # where each source's last pass ends: first in which run of blocks (as many runs as blocks in one), then in which block
    goals = spark.createDataFrame([(p[0], p[3] - p[7] * p[2], math.isqrt(p[4]) + 1) for p in plan],
                                  "s int, rest double, width long")
    runs = blocks.join(checked(goals), "s").withColumn("run", F.expr("block div width"))

    def crossed(rows: DataFrame, by: str) -> DataFrame:
        """The row of each source in which the running sum of words passes what is left of the target."""
        order = Window.partitionBy("s").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
        return rows.where("before <= rest and before + words > rest")

    found = crossed(runs.groupBy("s", "run", "rest").agg(F.sum("words").alias("words")), "run")
    found = found.select("s", "run", (F.col("rest") - F.col("before")).alias("rest"))
    found = crossed(runs.drop("rest").join(checked(settle(found)), ["s", "run"]), "block")
    ends = {r["s"]: (r["block"], float(r["room"])) for r in found.select(
        "s", "block", (F.col("rest") - F.col("before")).alias("room")).collect()}
    quota, last = np.zeros(len(plan), np.int64), []
    for s, *_, n, _, _, passes in plan:
        block, room = ends.get(s, (0, 0.0))
        quota[s] = passes * n + block + (room > 0)
        last.append((s, n, passes, block, room))
    turns = blocks.join(checked(spark.createDataFrame(
        last, "s int, blocks long, passes int, edge long, left double")), "s").withColumn("pass", F.explode(F.expr(
            "filter(sequence(0, passes), p -> p < passes or block < edge or (block = edge and left > 0))")))
    drawn = turns.select("s", "pass", "block", (F.col("pass") * F.col("blocks") + F.col("block")).alias("draw"),
                         F.expr("case when pass = passes and block = edge then left end").alias("room"))

    def leaves(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"]:
                first, number = split_quotas(quota, shards, int(k), seed)
                yield pd.DataFrame({"shard": int(k), "s": np.arange(len(quota)), "first": first, "number": number})

    owned = spark.range(shards).mapInPandas(leaves, "shard long, s int, first long, number long").where(
        "number > 0").select("shard", "s", F.explode(
            F.sequence(F.col("first"), F.col("first") + F.col("number") - 1)).alias("draw"))
    made.draws = settle(drawn.join(owned, ["s", "draw"]).select("s", "pass", "block", "room", "shard"))
    # in a source's last block (a 64th of a shard) documents are taken in hash order while that brings it nearer
    edges = settle(made.draws.where("room is not null").select("s", "block", "room"))
    run = Window.partitionBy("s").orderBy("u", "key", "mark").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.join(checked(edges), ["s", "block"]).groupBy("s", "u", "key", "mark", "room").agg(
        F.sum("size").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(run), F.lit(0)))
    made.partial = settle(edge.where(F.col("before") + F.col("size") / 2 <= F.col("room")).select("s", "key", "mark"))
    return made
