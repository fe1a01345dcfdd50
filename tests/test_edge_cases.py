from pyspark.sql import functions as F

from fixtures import obs_df
from rastercube.operators import grid, zones
from rastercube.operators.stats import date_stats
from rastercube.sources import testdata as td


def _empty(spark):
    return obs_df(spark).filter(F.lit(False))


def test_empty_observations(spark):
    e = _empty(spark)
    assert date_stats(e).count() == 0
    assert date_stats(e, method="builtin").count() == 0
    assert zones.zone_stats(e, td.test_boxes(spark)).count() == 0
    by_date, by_zone = zones.date_and_zone_stats(e, td.test_boxes(spark))
    assert by_date.count() == 0 and by_zone.count() == 0
    means = grid.block_means(e, 10)
    assert grid.dense_cube(means).count() == 0
    assert grid.series_from_means(means).count() == 0
    assert grid.time_axis(e).count() == 0


def test_no_zones(spark):
    from rastercube.schema import ZONE_BOXES

    none = spark.createDataFrame([], ZONE_BOXES)
    o = obs_df(spark)
    assert zones.zone_stats(o, none).count() == 0
    assert zones.zone_stats(o, none, strategy="cells").count() == 0
    assert zones.zone_stats(o, none, strategy="union").count() == 0
    by_date, by_zone = zones.date_and_zone_stats(o, none)
    assert by_date.count() == 2 and by_zone.count() == 0


def test_single_observation(spark):
    one = obs_df(spark).filter((F.col("date") == "2024-03-05") & (F.col("row") == 0))
    r = date_stats(one).first()
    assert r.pixel_count == 1 and r.ndvi_std is None and r.ndvi_p25 == r.ndvi_p75 == r.ndvi_mean
    cube = grid.dense_cube(grid.block_means(one, 10))
    assert cube.count() == 1
