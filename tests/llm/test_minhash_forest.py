import random
import re

import numpy as np
import pytest

from rastercube.llm import minhash_forest as forest

SCHEMA = "doc_id long, text string"


def plain_set(text, k=5):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def plain(rows, percent=85):
    """(doc_id, n_shingles, component_id, kept) by all pairs."""
    sets = [plain_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        low.setdefault(root(i), []).append(r[0])
    out = []
    for i, r in enumerate(rows):
        least = min((x for x in low[root(i)] if x is not None), default=None)
        out.append((r[0], len(sets[i]), least, r[0] == least))
    return sorted(out, key=repr)


def near_copies(n, seed):
    """Texts of which many are copies with some words changed, around the threshold, and copies of those again."""
    rng = random.Random(seed)
    texts = []
    while len(texts) < n:
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((4, 5, 6, 30, 120, 400)))]
        for _ in range(rng.choice((1, 1, 2, 6))):
            if rng.random() < 0.5 or not texts:
                words = list(base)
            else:
                words = rng.choice(texts[-6:]).split()
            for _ in range(rng.randrange(1 + len(words) // 40)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(9000)}"
            texts.append(" ".join(words))
    return texts


def result(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_documents_against_all_pairs(docs, rows):
    assert result(forest.near_duplicates(docs)) == plain(rows)


def test_near_copies_against_all_pairs(spark):
    rows = list(enumerate(near_copies(600, 3)))
    random.Random(4).shuffle(rows)
    assert result(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(6))) == plain(rows)


def test_dense_region_over_several_blocks(spark, monkeypatch):
    """A group far larger than the window, cut by block edges, beside others."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(300)] = f"y{i}"
        rows.append((i, " ".join(words)))
    rows += [(400 + i, t) for i, t in enumerate(near_copies(100, 5))]
    monkeypatch.setattr(forest, "BLOCK_ROWS", 64)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(forest)
    try:
        got = result(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(6)))
    finally:
        cloudpickle.unregister_pickle_by_value(forest)
    assert got == plain(rows)


def test_signature_values_agree_as_often_as_the_sets():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 2**63, 1200).astype(np.uint64))
    a, b = forest.signature(x[:1000]), forest.signature(x[100:1100])
    assert abs(np.mean(a == b) - 900 / 1100) < 0.12
    assert np.mean(forest.signature(x[:500]) == forest.signature(x[600:])) < 0.05


def test_sets_of_texts():
    assert len(forest.shingle_set(b"")) == len(forest.shingle_set(b" \n\t")) == 0
    assert len(forest.shingle_set(b"one two")) == len(forest.shingle_set(b"a b c d e")) == 1
    assert (forest.shingle_set(b"A b  C\td\ne f") == forest.shingle_set(b"a B c d e F")).all()
    assert len(forest.shingle_set(b"a " * 100)) == 1


def test_rerun_on_other_partitions(docs):
    assert result(forest.near_duplicates(docs)) == result(forest.near_duplicates(docs.repartition(2)))


def test_empty(no_docs, spark):
    assert result(forest.near_duplicates(no_docs)) == []
    only = spark.createDataFrame([(1, None), (2, ""), (None, " ")], SCHEMA)
    assert result(forest.near_duplicates(only)) == plain([(1, None), (2, ""), (None, " ")])


def test_parameters_are_checked(no_docs):
    with pytest.raises(ValueError):
        forest.near_duplicates(no_docs, percent=0)


def hidden_pairs():
    """Texts of one region that are not linked, and copies of some that are linked with these only."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(1000)]

    def changed(words, n, tag):
        words = list(words)
        for at in rng.sample(range(1000), n):
            words[at] = f"{tag}c{at}"
        return words
    texts = [changed(base, 12, f"t{i}") for i in range(260)]
    return [" ".join(t) for t in texts + [changed(t, 15, f"u{i}") for i, t in enumerate(texts[:60])]]


def test_links_inside_a_large_region(spark):
    """pairs that are neighbours in no order, since very many others lie between them, are found."""
    rows = list(enumerate(hidden_pairs()))
    want = plain(rows)
    assert len({r[2] for r in want}) < len(want)
    assert result(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))) == want


def test_large_regions_in_parts(spark, monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(forest, "PART_ROWS", 40)
    monkeypatch.setattr(forest, "LINES", 7)
    rows = list(enumerate(hidden_pairs()))
    cloudpickle.register_pickle_by_value(forest)
    try:
        got = result(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)))
    finally:
        cloudpickle.unregister_pickle_by_value(forest)
    assert got == plain(rows)


def test_large_regions_make_no_pairs(spark, monkeypatch):
    """op11: a set is moved once for each part of its regions, and not for each pair in them."""
    rows = list(enumerate(hidden_pairs()))
    met, real = [], forest.links
    monkeypatch.setattr(forest, "links", lambda pairs, *a: met.append(pairs.count()) or real(pairs, *a))
    inside, whole = [], forest.region_links

    def region(*a):
        inside.append(whole(*a))
        return inside[0]
    monkeypatch.setattr(forest, "region_links", region)
    assert result(forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))) == plain(rows)
    assert sum(met) <= 2 * forest.TREES * len(rows) and inside[0].count() <= forest.TREES * len(rows)
