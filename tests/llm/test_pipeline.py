import re

import corpus_pipeline as cp
from rastercube.llm import exact_dedup, quality, simhash
from test_quality import plain
from test_simhash import plain_components, plain_fingerprint


def test_stages(spark, docs, rows, tmp_path):
    spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = []
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append([(r.doc_id, r.text) for r in docs.collect()])
    # quality: only the base test can be certified here
    first = [(r[0], r[1]) for r in rows if (c := plain(r[1]))[0] >= 50 and 100 * c[4] <= 50 * c[0]]
    assert sorted(kept[0], key=repr) == sorted(first, key=repr)
    # exact: one row of each text, that of the largest id
    best = {}
    for i, t in first:
        best[t] = max(best.get(t, -1), i)
    assert sorted(kept[1]) == sorted((i, t) for t, i in best.items())
    # near: the smallest id of each component
    items = [(i, plain_fingerprint(t)) for t, i in best.items()]
    component = plain_components(items, 4)
    assert sorted(i for i, _ in kept[2]) == sorted({c for c in component})
    # mix: only what was kept, none more than twice
    assert set(kept[3]) <= set(kept[2]) and all(kept[3].count(x) <= 2 for x in kept[3])
    pieces = cp.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in kept[3]}


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (2, text + " more"), (2, "quite " + text), (None, "else"),
            (None, "else"), (None, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    exact = [tuple(r) for r in cp.exact(spark, df, "").collect()]
    assert sorted(exact, key=repr) == sorted([(1, text), (2, text + " more"), (2, "quite " + text), (None, "else"), (5, "")], key=repr)
    near = [tuple(r) for r in cp.near(spark, df, "").collect()]
    parts = {}
    items = [(i, plain_fingerprint(t)) for i, t in rows]
    for (i, c) in items:
        parts.setdefault(next(k for k in [x for _, x in items] if (k ^ c).bit_count() <= 4), []).append(i)
    assert len(near) == len(set(map(repr, near)))
    assert len(near) <= len(exact) and any(i == 1 for i, _ in near) and any(i == 5 for i, _ in near)


def test_empty(spark, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, str(tmp_path)).count() == 0
