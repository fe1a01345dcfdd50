import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rastercube.llm import collocation

SCHEMA = "text string, lang string"


def plain(rows, least=30, share=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from counts of all phrases."""
    out = []
    for lang in sorted({"und" if r[1] is None else r[1] for r in rows}):
        f, n = Counter(), 0
        for text, x in rows:
            if ("und" if x is None else x) != lang:
                continue
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
        f = {p: c for p, c in f.items() if c >= least}
        found = []
        for p, a in f.items():
            if len(p) < 2:
                continue
            inside = any(len(q) > len(p) and 100 * f[q] >= share * a and any(
                q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q in f)
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, i, p.decode(), -a, left, right, n, -score))
    return out


def texts(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["Ärger", "naïve", "日本", "A-b", "$5"]
    fixed = ["new york city hall", "New York", "a b c d e f", "Machine learning"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randrange(1, 6))))
            parts.append(rng.choice([" ", " ", ". ", ", ", "\n", "\t", " ! ", "\x0b", "  "]))
        rows.append(("".join(parts), ["en", "de", None, "und", ""][i % 5]))
    return rows + [(None, "en"), ("", "en"), (" .,; ", None), ("end. " * 40, "de"), ("go " * 5000, "en"), ("x" * 5000, "en")] + rows[:30]


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def test_against_plain_counts(spark):
    rows = texts(700, 1)
    got = result(collocation.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == sorted(plain(rows)) and len(got) > 20


def test_documents(docs, rows):
    assert result(collocation.collocations(docs)) == sorted(plain([(r[1], r[2]) for r in rows]))


def test_short_lists(spark):
    rows = texts(300, 2)
    got = result(collocation.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=10, top=7))
    assert got == sorted(plain(rows, least=10, top=7))


def test_small_chunks_many_buckets_and_shared_fingerprints(spark, monkeypatch):
    """Six bits of fingerprint: nearly all n-grams share theirs with others, within chunks and across them."""
    rows = texts(250, 3)
    monkeypatch.setattr(collocation, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(collocation, "BUCKET_GRAMS", 2000)
    cloudpickle.register_pickle_by_value(collocation)
    try:
        many = result(collocation.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=20))
        wide = collocation.Grams.fingerprints
        monkeypatch.setattr(collocation.Grams, "fingerprints", lambda g, s, n: wide(g, s, n) >> np.uint64(10) << np.uint64(10) if n < 2
                            else wide(g, s, n) & np.uint64(0xFC0000000000))
        few = result(collocation.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), least=20))
    finally:
        cloudpickle.unregister_pickle_by_value(collocation)
    assert many == few == sorted(plain(rows, least=20))


def test_counts_past_64_bits(spark):
    big = 2**62
    frequent = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 5), ("en", 2, "a b", big - 7)],
                                     "lang string, words int, phrase string, f long")
    r = collocation.scored(frequent).first()
    assert (r.score, r.l, r.r) == (2000000 * (big - 7) // (2 * big + 5), big, big + 5)


def test_only_frequent_phrases_are_written_out(spark):
    rows = texts(300, 4)
    frequent, totals = collocation.frequent_phrases(spark.createDataFrame(rows, SCHEMA), 25)
    assert frequent.where(F.col("f") < 25).count() == 0 and frequent.count() > 0
    assert {r.lang for r in totals.collect()} == {"en", "de", "und", ""}


def test_empty(no_docs, spark):
    assert result(collocation.collocations(no_docs)) == []
    assert result(collocation.collocations(spark.createDataFrame([(None, None), (" .", "en")], SCHEMA))) == []


@pytest.mark.parametrize("text, want", [(b"", b""), (b" A\tb ", b"a b"), (b"a.B", b"a \xff b"), ("Ä, x".encode(), "Ä".encode() + b" \xff x")])
def test_tokens(text, want):
    assert collocation.tokens(text) == want
