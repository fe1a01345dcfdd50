import math
import re
from collections import Counter

import pytest

from rastercube.llm import quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1) for i in range(60)] + [(3, 0), (None, 1), (9, None)], "doc_id long, quality int")


def test_counts_and_base(docs, rows, labels):
    got = quality.quality(docs, labels).collect()
    assert len(got) == len(rows)
    have = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert have == sorted((repr(r[0]), *plain(r[1])) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_upper_bound_is_the_exact_binomial_one():
    for k, n, delta in ((0, 100, 0.05), (3, 50, 0.01), (10, 1000, 0.001)):
        p = quality.upper_bound(k, n, delta)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - delta) < 1e-6
    assert quality.upper_bound(5, 5, 0.1) == 1.0


def many(spark, n=9000):
    import random

    rng = random.Random(3)
    words = [f"v{i}" for i in range(400)]
    out = []
    for i in range(n):
        bad = i % 7 == 0
        w = rng.choices(words, k=80)
        out.append((i, " ".join(w if not bad else [x + " %%%" for x in w]), "en" if i % 3 else "xx", 0 if bad else 1))
    return spark.createDataFrame(out, "doc_id long, text string, lang string, quality int")


def test_certified_rules_reject_junk_and_hold_the_risk(spark):
    df = many(spark)
    labels = df.where("doc_id % 2 = 0").select("doc_id", "quality")
    got = {r.doc_id: r.kept for r in quality.quality(df.drop("quality"), labels).collect()}
    truth = {r.doc_id: r.quality for r in df.collect()}
    assert all(got[i] for i, q in truth.items() if q)
    assert not any(got[i] for i, q in truth.items() if not q)
    kept = quality.kept_documents(df, labels)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}


def test_kept_documents_agree_with_the_verdicts(docs, labels):
    got = quality.quality(docs, labels)
    assert sorted(map(repr, (r.doc_id for r in quality.kept_documents(docs, labels).collect()))) == sorted(
        map(repr, (r.doc_id for r in got.collect() if r.kept)))


def test_few_labels_certify_nothing(spark):
    df = many(spark, 60)
    assert all(r.kept for r in quality.quality(df, df.select("doc_id", "quality")).collect())
    none = df.select("doc_id", "quality").limit(0)
    assert all(r.kept for r in quality.quality(df, none).collect())


def test_empty(no_docs, labels):
    assert quality.quality(no_docs, labels).count() == 0
    assert quality.kept_documents(no_docs, labels).count() == 0
