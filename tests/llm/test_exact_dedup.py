import hashlib
import random

import pytest

from rastercube.llm import exact_dedup
from rastercube.llm.common import checked_bytes


def test_against_grouping_by_text(docs, rows):
    got = exact_dedup.exact_duplicates(docs).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    assert len(got) == len(rows)
    for text, ids in groups.items():
        sha = hashlib.sha256(text.encode()).hexdigest()
        mine = [r for r in got if r.text_sha256 == sha]
        keep = max((i for i in ids if i is not None), default=None)
        assert sorted(map(repr, (r.doc_id for r in mine))) == sorted(map(repr, ids))
        assert {(r.keep_id, r.group_size) for r in mine} == {(keep, len(ids))}
        assert [r.doc_id for r in mine if r.kept] == [keep]


def test_colliding_identifiers_are_found_and_named_anew(docs, rows, monkeypatch):
    plain = exact_dedup.chunk_id
    monkeypatch.setattr(exact_dedup, "chunk_id", lambda c, seed: plain(c, seed)[:1] if seed < 2 else plain(c, seed))
    # the functions run in workers, which import them anew: pass the weak one along by value
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(exact_dedup)
    try:
        got = exact_dedup.exact_duplicates(docs).collect()
    finally:
        cloudpickle.unregister_pickle_by_value(exact_dedup)
    assert sum(r.kept for r in got) == len({r[1] or "" for r in rows})


@pytest.mark.parametrize("n", [0, 1, 1024, 1025, 40_000, 200_000])
def test_chunks_join_to_the_text(n):
    text = random.Random(n).randbytes(n) if n != 40_000 else b"x" * n
    parts = exact_dedup.chunks(text)
    assert b"".join(parts) == text
    assert all(0 < len(p) <= exact_dedup.MAX_CHUNK for p in parts)


def test_chunks_meet_again_after_an_insertion():
    text = random.Random(1).randbytes(100_000)
    a, b = exact_dedup.chunks(text), exact_dedup.chunks(b"new" + text)
    assert len(set(a) & set(b)) > len(a) / 2


def test_empty(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0


def test_groups_are_broadcast_by_bytes(spark, docs, monkeypatch):
    few = spark.createDataFrame([(i, bytes(1000)) for i in range(20)], "n long, recipe binary")
    hinted = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(checked_bytes(few, 20 * 1032)) and not hinted(checked_bytes(few, 20 * 1032 - 1))
    assert hinted(checked_bytes(few.where("n < 0"), 0))
    want = sorted(map(repr, exact_dedup.exact_duplicates(docs).collect()))
    monkeypatch.setattr(exact_dedup, "checked_bytes", lambda df: checked_bytes(df, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(repr, exact_dedup.exact_duplicates(docs).collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
