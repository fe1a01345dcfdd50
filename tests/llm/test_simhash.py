import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from rastercube.llm import simhash


def plain_fingerprint(text, k=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) > k else [" ".join(words)] if words else []
    out = 0
    for b in range(64):
        ones = sum(xxhash.xxh64_intdigest(g.encode(), 42) >> b & 1 for g in grams)
        out |= (2 * ones > len(grams)) << b
    return out


def plain_components(items, max_bits):
    """Least id of each item's component, over (id, code) items."""
    parent = list(range(len(items)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(items):
        r = root(i)
        low[r] = min([x for x in (low.get(r), d) if x is not None], default=None)
    return [low[root(i)] for i in range(len(items))]


def test_documents_against_all_pairs(docs, rows):
    items = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = sorted(((d, f"{c:016x}", k) for (d, c), k in zip(items, plain_components(items, 4))), key=repr)
    got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_links_of_planted_codes(spark, monkeypatch):
    rng = random.Random(1)
    codes = {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    for c in list(codes)[:120]:
        for _ in range(4):
            near = c
            for b in rng.sample(range(64), rng.randint(1, 6)):
                near ^= 1 << b
            codes.add(near)
    centre = rng.getrandbits(64)  # a dense cluster, so that whole nodes link
    for _ in range(400):
        codes.add(centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    items = [(c, c) for c in sorted(codes)]
    want = dict(zip(sorted(codes), plain_components(items, 4)))
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    for split in (100_000, 40):  # the second splits patterns into blocks
        monkeypatch.setattr(simhash, "SPLIT_ROWS", split)
        edges = simhash.fingerprint_links(df, 4).collect()
        parent = {c: c for c in codes}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for u, v in ((u % 2**64, v % 2**64) for u, v in edges):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
        assert {c: root(c) for c in codes} == want


def test_masks_leave_one_whole():
    rng = random.Random(2)
    for n in (10, 10**7, 10**9, 10**12):
        masks = simhash.segment_masks(n, 4)
        for _ in range(200):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not diff & m for m in masks)


def test_gray_rank_orders_the_gray_sequence():
    i = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(i ^ (i >> np.uint64(1))) == i).all()


def test_empty(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


def test_joins_of_a_hub_are_split(spark, monkeypatch):
    """A node with nearly all edges: both star steps find it, in joins that AQE splits."""
    from rastercube.llm import common

    held = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.files.maxPartitionBytes": "256k"}
    plans, before, settle = [], {k: spark.conf.get(k, None) for k in held}, common.settle

    def settled(df):
        execution = df._jdf.queryExecution()
        execution.toRdd().count()  # so that the plan is the final one
        plans.append(execution.executedPlan().toString())
        return settle(df)

    monkeypatch.setattr(common, "settle", settled)
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        for hub in (0, 1 << 40):
            plans.clear()
            other = F.xxhash64("id").bitwiseAND(F.lit((1 << 39) - 1))
            edges = spark.range(1, 400_001).select(F.lit(hub).cast("long").alias("u"), other.alias("v"))
            found = common.connected_components(edges)
            assert found.select("root").distinct().count() == 1 and found.count() == 400_001
            assert any("SortMergeJoin(skew=true)" in p for p in plans)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
