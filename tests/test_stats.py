import math
import random

import pytest
from pyspark.sql import functions as F

from fixtures import obs_df, raw_df
from rastercube.operators.quantile import bucket_key, grouped_summary
from rastercube.operators.stats import date_stats, five_measures


def _rows(df):
    return {r["date"]: r for r in df.collect()}


@pytest.mark.parametrize("method", ["exact", "builtin"])
def test_date_stats_golden(spark, method):
    got = _rows(date_stats(obs_df(spark), method=method))
    a, b = got["2024-01-05"], got["2024-03-05"]
    assert a.pixel_count == 3 and b.pixel_count == 2
    assert a.ndvi_mean == pytest.approx(0.0, abs=1e-7)
    assert a.ndvi_std == pytest.approx(0.5, abs=1e-7)
    assert (a.ndvi_p25, a.ndvi_p75) == (pytest.approx(-0.25), pytest.approx(0.25))
    assert b.ndvi_mean == pytest.approx(0.3, abs=1e-7)
    assert b.ndvi_std == pytest.approx(0.424264, abs=1e-6)
    assert (b.ndvi_p25, b.ndvi_p75) == (pytest.approx(0.15, abs=1e-7), pytest.approx(0.45, abs=1e-7))


def test_box_stats_golden_and_single_value_std_is_null(spark):
    from rastercube.operators.zones import bbox_filter

    got = _rows(date_stats(bbox_filter(obs_df(spark), 0, 0, 0, 10)))
    a, b = got["2024-01-05"], got["2024-03-05"]
    assert (a.pixel_count, b.pixel_count) == (2, 1)
    assert a.ndvi_mean == pytest.approx(0.25) and a.ndvi_std == pytest.approx(0.353553, abs=1e-6)
    assert (a.ndvi_p25, a.ndvi_p75) == (pytest.approx(0.125), pytest.approx(0.375))
    assert b.ndvi_std is None and b.ndvi_p25 == 0.0 and b.ndvi_p75 == 0.0


def test_masked_rows_and_ndvi_range(spark):
    o = obs_df(spark)
    assert o.count() == 5
    assert o.filter((F.col("red") <= 0) | (F.col("nir") <= 0)).count() == 0
    assert o.filter((F.col("ndvi") < -1) | (F.col("ndvi") > 1)).count() == 0


def test_guarded_ratio_never_raises_under_ansi(spark):
    from rastercube.operators.bands import with_ndvi

    rows = with_ndvi(raw_df(spark)).filter((F.col("red") + F.col("nir")) == 0).collect()
    assert len(rows) == 1 and rows[0].ndvi is None


def test_bucket_key_is_order_preserving(spark):
    vals = [-3.5, -1.0, -0.75, -1e-30, 0.0, 1e-300, 2.0**-20, 0.1, 0.5, 0.99999, 1.0, 1.5, 2.0, 1e10]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    keys = [r.k for r in df.select(bucket_key(F.col("v")).alias("k")).collect()]
    assert keys == sorted(keys)
    assert len(set(keys)) == len(keys)


def _compare_with_builtin(spark, data, probs=(0.25, 0.5, 0.75, 0.1, 0.99), **kw):
    df = spark.createDataFrame(data, "g string, v double")
    ours = grouped_summary(df, ["g"], "v", list(probs), **kw).collect()
    ref = df.groupBy("g").agg(
        F.avg("v").alias("mean"),
        F.stddev_samp("v").alias("std"),
        F.count("v").alias("n"),
        *[F.percentile("v", p).alias(f"p{i}") for i, p in enumerate(probs)],
    ).collect()
    ours = {r.g: r for r in ours}
    assert set(ours) == {r.g for r in ref}
    for r in ref:
        o = ours[r.g]
        assert o.n == r.n
        for c in ["mean", "std"] + [f"p{i}" for i in range(len(probs))]:
            if r[c] is None:
                assert o[c] is None, (r.g, c)
            elif math.isnan(r[c]):
                assert math.isnan(o[c]), (r.g, c)
            else:
                assert o[c] == pytest.approx(r[c], rel=1e-9, abs=1e-12), (r.g, c, o[c], r[c])


def test_exact_percentiles_match_builtin_random(spark):
    rnd = random.Random(7)
    data = []
    for g in "abcde":
        n = rnd.choice([1, 2, 3, 10, 257, 3000])
        for _ in range(n):
            data.append((g, rnd.gauss(0.1, 0.3)))
    data += [("ties", 0.5)] * 50 + [("ties", -0.5)] * 30 + [("ties", 0.0)] * 7
    data += [("nulls", None), ("nulls", 1.0), ("nulls", 2.0)]
    data += [("allnull", None)]
    data += [("inf", float("inf")), ("inf", 1.0), ("inf", float("-inf")), ("inf", 2.0), ("inf", 3.0)]
    _compare_with_builtin(spark, data)


def test_refinement_rounds_and_non_broadcast_path(spark):
    rnd = random.Random(3)
    # values packed in a narrow range so one histogram bucket holds many rows
    data = [("h", 0.5 + rnd.random() * 1e-6) for _ in range(4000)] + [("h", rnd.random()) for _ in range(100)]
    _compare_with_builtin(spark, data, exact_rows=50, refine_buckets=16, broadcast_rows=0)


def test_auto_counts_before_it_chooses(spark, monkeypatch):
    from rastercube.operators import stats

    nan = float("nan")
    rows = [("a", float(i)) for i in range(10)] + [("b", 1.0), ("b", nan), ("b", None), ("c", nan), ("d", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "date string, ndvi double")
    ran = []
    distributed = stats.grouped_summary
    monkeypatch.setattr(stats, "grouped_summary", lambda *a, **k: ran.append(1) or distributed(*a, **k))
    want = [(None, 3.0, None, 3.0, 3.0, 1), ("a", 4.5, 3.02765, 2.25, 6.75, 10), ("b", 1.0, None, 1.0, 1.0, 1),
            ("c", None, None, None, None, 0), ("d", None, None, None, None, 0)]
    for limit, runs in ((10, 0), (9, 1)):
        got = five_measures(df, ["date"], method="auto", one_pass_rows=limit).collect()
        assert sorted((tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in got),
                      key=lambda r: r[0] or "") == want
        assert len(ran) == runs
    assert five_measures(df.limit(0), ["date"], method="auto").count() == 0


def test_five_measures_methods_agree(spark):
    from rastercube.sources.testdata import obs
    from fixtures import SF001

    o = obs(spark, SF001)
    a = {r.date: r for r in five_measures(o, ["date"], method="exact").collect()}
    b = {r.date: r for r in five_measures(o, ["date"], method="builtin").collect()}
    assert a.keys() == b.keys()
    for d in a:
        for c in ["ndvi_mean", "ndvi_std", "ndvi_p25", "ndvi_p75", "pixel_count"]:
            if b[d][c] is None:
                assert a[d][c] is None
            else:
                assert a[d][c] == pytest.approx(b[d][c], rel=1e-9, abs=1e-12)
    approx = five_measures(o, ["date"], method="approx").collect()
    assert len(approx) == len(a)
    assert all(r.ndvi_p25 <= r.ndvi_p75 for r in approx)


def test_no_python_in_statistics_plan(spark):
    from rastercube.sources.testdata import obs
    from fixtures import SF001

    df = date_stats(obs(spark, SF001))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert not math.isnan(df.count())


def test_invariants_on_testdata(spark):
    from rastercube.sources.testdata import obs
    from fixtures import SF001

    st = date_stats(obs(spark, SF001)).collect()
    assert all(r.ndvi_p25 <= r.ndvi_p75 for r in st)
    assert all(-1.0 <= r.ndvi_p25 and r.ndvi_p75 <= 1.0 for r in st)
    assert sum(r.pixel_count for r in st) == obs(spark, SF001).count()


def test_scale_offset_and_extra_mask(spark):
    from rastercube.operators.bands import mask_valid, with_ndvi

    raw = raw_df(spark)
    # reflectance = dn * 0.0001 - 0.1: the ratio changes, the mask is unchanged
    scaled = with_ndvi(mask_valid(raw), scale=0.0001, offset=-0.1).collect()
    by_key = {(r.date, r.row, r.col): r.ndvi for r in scaled}
    assert by_key[("2024-01-05", 0, 0)] == pytest.approx((0.2 - 0.0) / (0.2 + 0.0), abs=1e-6)
    masked = mask_valid(raw, extra=F.col("row") == 0).count()
    assert masked == 3


def test_forced_refinement_on_testdata_matches_builtin(spark):
    from rastercube.sources.testdata import obs
    from fixtures import SF001

    o = obs(spark, SF001)
    kw = dict(exact_rows=5, refine_buckets=8, broadcast_rows=10)
    a = {r.date: r for r in five_measures(o, ["date"], method="exact", **kw).collect()}
    b = {r.date: r for r in five_measures(o, ["date"], method="builtin").collect()}
    assert a.keys() == b.keys()
    for d in b:
        for c in ["ndvi_mean", "ndvi_std", "ndvi_p25", "ndvi_p75", "pixel_count"]:
            if b[d][c] is None:
                assert a[d][c] is None
            else:
                assert a[d][c] == pytest.approx(b[d][c], rel=1e-9, abs=1e-12)


def test_results_come_in_order(spark):
    """SRT1 and SRT2: by date, and by zone and date."""
    from fixtures import SF001
    from rastercube.operators import zones
    from rastercube.sources import testdata as td

    from rastercube.operators import stats

    obs = td.obs(spark, SF001)
    dates = [r.date for r in stats.date_stats(obs).collect()]
    assert len(dates) > 10 and dates == sorted(dates)
    boxes = td.test_boxes(spark) if hasattr(td, "test_boxes") else spark.createDataFrame(
        td.TEST_BOXES, "zone string, row_min int, row_max int, col_min int, col_max int")
    keys = [(r.zone, r.date) for r in zones.zone_stats(obs, boxes).collect()]
    assert len(keys) > 10 and keys == sorted(keys)
    by_date, by_zone = zones.date_and_zone_stats(obs, boxes)
    assert [r.date for r in by_date.collect()] == dates
    assert [(r.zone, r.date) for r in by_zone.collect()] == keys
