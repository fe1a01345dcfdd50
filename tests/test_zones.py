import pytest
from pyspark.sql import functions as F

from fixtures import SF001
from fixtures import obs_df
from rastercube.operators import zones
from rastercube.sources import testdata as td

# Golden bounds (native pixels) of the reference zones with the reference
# georeference: three of four collapse onto column 0 through the clamp.
GOLDEN = {
    "Centro Storico": (5610, 6210, 0, 0),
    "Villa Borghese": (5477, 5877, 0, 0),
    "Castelli Romani": (7046, 8046, 376, 1376),
    "Agro Romano": (5852, 6852, 0, 0),
}
GOLDEN_UTM = {
    "Centro Storico": (291938.494, 4640937.990),
    "Villa Borghese": (292006.708, 4643269.801),
    "Castelli Romani": (308769.810, 4624576.159),
    "Agro Romano": (280009.894, 4636517.630),
}


def test_utm_goldens(spark):
    rows = zones.with_utm(zones.reference_zones(spark)).collect()
    for r in rows:
        e, n = GOLDEN_UTM[r.zone]
        assert r.easting == pytest.approx(e, abs=0.002)
        assert r.northing == pytest.approx(n, abs=0.002)


def test_zone_bounds_clamp_goldens(spark):
    rows = zones.zone_pixel_bounds(zones.reference_zones(spark)).collect()
    got = {r.zone: (r.row_min, r.row_max, r.col_min, r.col_max) for r in rows}
    assert got == GOLDEN
    off = {r.zone: r.off_tile for r in rows}
    assert off["Castelli Romani"] is False and off["Centro Storico"] is True


def test_zone_bounds_drop(spark):
    rows = zones.zone_pixel_bounds(zones.reference_zones(spark), off_tile="drop").collect()
    assert {r.zone for r in rows} == {"Castelli Romani"}


def test_zone_bounds_alternative_origin(spark):
    rows = zones.zone_pixel_bounds(zones.reference_zones(spark), origin_x=199980.0, off_tile="clamp").collect()
    got = {r.zone: (r.col_min, r.col_max) for r in rows}
    assert got["Centro Storico"] == (8895, 9495)
    assert got["Agro Romano"] == (7502, 8502)


def _stats(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_strategies_agree_on_testdata(spark):
    o = td.obs(spark, SF001)
    boxes = td.test_boxes(spark)
    a = _stats(zones.zone_stats(o, boxes, strategy="inline"))
    b = _stats(zones.zone_stats(o, boxes, strategy="cells", cell=250))
    c = _stats(zones.zone_stats(o, boxes, strategy="union"))
    d = _stats(zones.zone_stats(o, boxes, strategy="cells", cell=100, max_broadcast_cells=0))
    e = _stats(zones.zone_stats(o, boxes, method="exact"))
    assert a == b == c == d == e
    assert "OFF" not in {r[0] for r in a}
    # a pixel may count in two zones: A and B overlap
    counts = {(r[0], r[1]): r[-1] for r in a}
    assert any(k[0] == "A" for k in counts) and any(k[0] == "B" for k in counts)


def test_counts_over_a_partition_of_boxes_sum_to_total(spark):
    from rastercube.schema import ZONE_BOXES

    o = obs_df(spark)
    boxes = spark.createDataFrame([("top", 0, 0, 0, 10), ("bottom", 10, 10, 0, 10)], ZONE_BOXES)
    st = zones.zone_stats(o, boxes)
    assert st.agg(F.sum("pixel_count")).first()[0] == o.count()


def test_bbox_filter_reaches_parquet_scan(spark, tmpdir_path):
    from rastercube.sources.store import read_observations, write_observations

    write_observations(td.obs(spark, SF001), tmpdir_path)
    o = read_observations(spark, tmpdir_path)
    q = zones.bbox_filter(o.filter(F.col("date") == "1996-03"), 0, 300, 0, 300)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "row" in plan.split("PushedFilters:")[1][:300]
    assert "PartitionFilters: [" in plan and "1996-03" in plan
    direct = zones.bbox_filter(td.obs(spark, SF001).filter(F.col("date") == "1996-03"), 0, 300, 0, 300)
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, direct.collect()))


def test_pivot_series_error_bars(spark):
    st = zones.zone_stats(td.obs(spark, SF001), td.test_boxes(spark))
    piv = zones.zone_pivot(st)
    assert piv.columns == ["date", "A", "B", "C", "EDGE"]
    ser = zones.zone_series(st).filter(F.col("zone") == "A").orderBy("pos").collect()
    assert [r.pos for r in ser] == list(range(len(ser)))
    assert all(r.band_lo <= r.band_hi for r in ser)
    assert all(abs(r.ndvi_mean + r.err_plus - r.band_hi) < 1e-12 for r in ser)


def test_shared_scan_statistics_equal_separate(spark):
    from rastercube.operators.stats import date_stats

    o = td.obs(spark, SF001)
    boxes = td.test_boxes(spark)
    by_date, by_zone = zones.date_and_zone_stats(o, boxes)
    assert _stats(by_date) == _stats(date_stats(o))
    assert _stats(by_zone) == _stats(zones.zone_stats(o, boxes))


def test_inline_membership_is_one_scan_without_join(spark, tmpdir_path):
    from rastercube.sources.store import read_observations, write_observations

    write_observations(td.obs(spark, SF001), tmpdir_path)
    o = read_observations(spark, tmpdir_path)
    tagged = zones.assign_zones(o.select("date", "row", "col", "ndvi"), td.test_boxes(spark), "inline")
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Join" not in plan and "Generate" in plan


def test_pivot_duplicate_is_error(spark):
    df = spark.createDataFrame([("A", "d1", 0.1), ("A", "d1", 0.2)], "zone string, date string, ndvi_mean double")
    with pytest.raises(Exception, match="duplicate"):
        zones.zone_pivot(df).collect()


def test_auto_strategy_switches_to_cells_for_many_zones(spark):
    from rastercube.schema import ZONE_BOXES

    o = td.obs(spark, SF001)
    many = spark.createDataFrame([(f"z{i}", 10 * i, 10 * i + 200, 0, 400) for i in range(80)], ZONE_BOXES)
    tagged = zones.assign_zones(o, many, "auto", cell=250)
    assert "Join" in tagged._jdf.queryExecution().executedPlan().toString()
    few = zones.assign_zones(o, td.test_boxes(spark), "auto")
    assert "Join" not in few._jdf.queryExecution().executedPlan().toString()
    a = _stats(zones.zone_stats(o, many))
    b = _stats(zones.zone_stats(o, many, strategy="inline", max_inline=100))
    assert a == b
