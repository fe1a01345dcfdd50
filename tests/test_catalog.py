from datetime import datetime

from pyspark.sql import functions as F

from rastercube.operators import catalog as cat
from rastercube.schema import CATALOG_PRODUCT


def _product(pid, start, attrs, name="S2A_MSIL2A_T33TTG", coll="SENTINEL-2", fp=None):
    return (pid, name, coll, (start,), attrs, fp)


def test_cloud_cover_cases(spark):
    rows = [
        _product("a", "2024-01-05T10:00:00.000Z", [("productType", "S2MSI2A"), ("cloudCover", "12.5")]),
        _product("b", "2024-01-06T10:00:00.000Z", [("cloudCover", None)]),
        _product("c", "2024-01-07T10:00:00.000Z", [("productType", "S2MSI2A")]),
        _product("d", "2024-01-08T10:00:00.000Z", None),
        _product("e", "2024-01-09T10:00:00.000Z", [("cloudCover", "3"), ("cloudCover", "99")]),
    ]
    df = spark.createDataFrame(rows, CATALOG_PRODUCT)
    got = {r.Id: r.c for r in df.select("Id", cat.cloud_cover().alias("c")).collect()}
    assert got == {"a": 12.5, "b": 100.0, "c": 50.0, "d": 50.0, "e": 3.0}


def test_catalog_filter_and_footprint(spark):
    sq = [(12.0, 41.5), (13.0, 41.5), (13.0, 42.5), (12.0, 42.5)]
    rows = [
        _product("in", "2024-02-01T00:00:00.000Z", [("productType", "S2MSI2A")], fp=sq),
        _product("s1", "2024-02-01T00:00:00.000Z", [("productType", "S2MSI2A")], coll="SENTINEL-1", fp=sq),
        _product("l1c", "2024-02-01T00:00:00.000Z", [("productType", "S2MSI1C")], fp=sq),
        _product("tile", "2024-02-01T00:00:00.000Z", [("productType", "S2MSI2A")], name="S2A_T32TQM", fp=sq),
        _product("late", "2025-02-01T00:00:00.000Z", [("productType", "S2MSI2A")], fp=sq),
        _product("out", "2024-02-01T00:00:00.000Z", [("productType", "S2MSI2A")], fp=[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]),
    ]
    df = spark.createDataFrame(rows, CATALOG_PRODUCT).withColumn("start", F.to_timestamp("ContentDate.Start"))
    f = cat.catalog_filter(df, start_after="2024-01-01", start_before="2024-12-31", name_contains="T33TTG")
    assert sorted(r.Id for r in f.collect()) == ["in", "out"]
    inside = {r.Id: r.x for r in df.select("Id", cat.footprint_contains(12.5, 41.9).alias("x")).collect()}
    assert inside["in"] and not inside["out"]


def _dated(*products):
    return [(i, datetime(2024, m, day), m, cloud) for i, m, day, cloud in products]


def test_selection_by_hand(spark):
    schema = "id long, start timestamp, month int, cloud double"
    # one product a month but two in March; February is no target month, so the others come first
    full = _dated(*[(m, m, 5, float(m)) for m in range(1, 13)], (20, 3, 9, 1.0))
    got = [r.id for r in cat.select_acquisitions(spark.createDataFrame(full, schema)).collect()]
    assert got == [1, 20, 4, 5, 6, 7, 8, 9]
    # three target months: their best, then the least cloudy of the rest (ties by start, then id), in date order
    few = _dated((1, 1, 2, 9.0), (2, 1, 3, 4.0), (3, 2, 1, 4.0), (4, 2, 1, 4.0), (5, 4, 8, 30.0), (6, 6, 1, 2.0), (7, 6, 2, 50.0))
    df = spark.createDataFrame(few, schema)
    assert [r.id for r in cat.select_acquisitions(df, n=5).collect()] == [2, 3, 4, 5, 6]
    assert [r.id for r in cat.select_acquisitions(df, n=8).collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert [r.id for r in cat.select_acquisitions(df, n=2).collect()] == [2, 5]


def test_month_best_ties(spark):
    rows = [(1, datetime(2024, 1, 9), 1, 5.0), (2, datetime(2024, 1, 3), 1, 5.0), (3, datetime(2024, 1, 3), 1, 5.0)]
    c = spark.createDataFrame(rows, "id long, start timestamp, month int, cloud double")
    assert cat.month_best(c).first().id == 2


def test_date_parts(spark):
    df = spark.createDataFrame([("2024-03-05T10:11:12.000Z",)], "start_iso string")
    r = cat.date_parts(df).first()
    assert (r.day, r.month, r.mmdd) == ("2024-03-05", 3, "03-05")


def test_max_cloud_and_manifest_from_selection(spark, tmpdir_path):
    import os

    from rastercube.sources.manifest import read_manifest, write_manifest

    rows = [
        _product(f"p{i}", f"2024-{m:02d}-0{1 + i % 5}T10:00:00.000Z", [("productType", "S2MSI2A"), ("cloudCover", str(c))])
        for i, (m, c) in enumerate([(1, 5.0), (1, 30.0), (2, 1.0), (3, 19.9), (3, 20.0), (7, 0.5), (12, 2.0)])
    ]
    df = spark.createDataFrame(rows, CATALOG_PRODUCT).withColumn("start", F.to_timestamp("ContentDate.Start"))
    low = cat.catalog_filter(df, max_cloud=20.0)
    assert sorted(r.Id for r in low.collect()) == ["p0", "p2", "p3", "p5", "p6"]
    sel = cat.select_acquisitions(cat.flatten(df))
    ids = [r.id for r in sel.collect()]
    # months 1, 3, 7, 12 give one each; the rest is filled by lowest cloud
    assert ids == ["p0", "p1", "p2", "p3", "p4", "p5", "p6"]
    out = os.path.join(tmpdir_path, "manifest")
    write_manifest(cat.manifest_rows(sel, "/data/raw/"), out)
    back = read_manifest(spark, out, multi_line=False).orderBy("date").collect()
    assert [r.id for r in back] == ids and back[0].path == "/data/raw/S2A_MSIL2A_T33TTG.zip"
    assert back[0].date == "2024-01-01" and back[0].cloud_cover == 5.0


def test_month_is_read_as_written(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2024-02-01T00:30:00.000Z",), ("2024-01-31T23:00:00+02:00",)], "start_iso string")
        assert [r.month for r in cat.date_parts(df).collect()] == [2, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
