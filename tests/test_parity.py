"""Every registered query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fixtures import SF001
from rastercube.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["date", "ndvi_mean", "ndvi_std", "ndvi_p25", "ndvi_p75", "pixel_count"]
    assert df.count() > 0


def test_every_key_has_an_oracle_or_is_declared_rows_only():
    own = set(QUERIES)
    assert own - set(oracle_sql()) == set()


@pytest.mark.parametrize("key", sorted(set(oracle_sql()) & set(QUERIES)))
def test_query_matches_duckdb(spark, con, key):
    df = queries()[key](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[key])
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_rows, s_cols) == _rows(d_rows, d_cols)
