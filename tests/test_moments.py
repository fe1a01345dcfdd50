"""Zone measures from prefix sums against those from the pixels."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import SF001, obs_df
from rastercube.operators import moments, zones
from rastercube.plans.queries import customer_boxes
from rastercube.schema import ZONE_BOXES
from rastercube.sources import testdata as td


def near(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) < 1e-9)


def same(got, want):
    got, want = got.collect(), want.collect()
    assert [tuple(r)[:-3] for r in got] == [tuple(r)[:-3] for r in want]
    for g, w in zip(got, want):
        assert g.pixel_count == w.pixel_count and near(g.ndvi_mean, w.ndvi_mean) and near(g.ndvi_std, w.ndvi_std), (g, w)


def measures(obs, boxes, by=None):
    return zones.zone_stats(obs, boxes, by=by).drop("ndvi_p25", "ndvi_p75")


@pytest.mark.parametrize("block", [1, 7, 64])
def test_equal_to_zone_stats(spark, block):
    obs = td.obs(spark, SF001)
    sums = moments.PrefixSums(obs, block=block)
    same(moments.zone_moments(sums, td.test_boxes(spark)), measures(obs, td.test_boxes(spark)))


def test_many_zones(spark):
    obs = td.obs(spark, SF001)
    rng = random.Random(1)
    boxes = []
    for i in range(1200):
        r, c = rng.randrange(-50, 1100), rng.randrange(-50, 1100)
        boxes.append((f"z{i:04}", r, r + rng.randrange(-5, 300), c, c + rng.randrange(300)))
    boxes = spark.createDataFrame(boxes, ZONE_BOXES)
    same(moments.zone_moments(obs, boxes), measures(obs, boxes))


def test_shuffled_corners(spark, monkeypatch):
    obs = td.obs(spark, SF001)
    monkeypatch.setattr(moments, "MAX_BROADCAST_CORNERS", 3)
    same(moments.zone_moments(obs, customer_boxes(spark, SF001)), measures(obs, customer_boxes(spark, SF001)))


def test_by_tile(spark):
    obs = td.obs(spark, SF001, tile=True)
    boxes = td.test_boxes(spark).select(F.explode(F.array(*[F.lit(f"T{k}") for k in (0, 2, 3)])).alias("tile_id"), "*")
    got = moments.zone_moments(obs, boxes, by_tile=True)
    same(got, measures(obs, boxes, by=["tile_id"]))


def test_by_hand_and_missing(spark):
    boxes = spark.createDataFrame([("all", 0, 10, 0, 10), ("top", 0, 5, 0, 99), ("none", 20, 30, 0, 0)], ZONE_BOXES)
    got = moments.zone_moments(obs_df(spark), boxes).collect()
    assert [(r.zone, r.date, round(r.ndvi_mean, 6), r.pixel_count) for r in got] == [
        ("all", "2024-01-05", 0.0, 3), ("all", "2024-03-05", 0.3, 2), ("top", "2024-01-05", 0.25, 2), ("top", "2024-03-05", 0.0, 1)]
    assert got[-1].ndvi_std is None
    odd = spark.createDataFrame([("d", 0, 0, float("nan")), ("d", 10, 0, None), ("d", 10, 10, 0.5)], "date string, row int, col int, ndvi float")
    assert [tuple(r) for r in moments.zone_moments(odd, boxes).collect()] == [("all", "d", 0.5, None, 1)]


def test_pixels_off_the_grid_are_an_error(spark):
    odd = spark.createDataFrame([("d", 3, 0, 0.5)], "date string, row int, col int, ndvi float")
    with pytest.raises(Exception, match="off the grid"):
        moments.zone_moments(odd, td.test_boxes(spark)).collect()


def test_empty(spark):
    assert moments.zone_moments(obs_df(spark).limit(0), td.test_boxes(spark)).collect() == []
    assert moments.zone_moments(obs_df(spark), td.test_boxes(spark).limit(0)).collect() == []


def test_boxes_of_one_name_and_of_the_same_cells(spark):
    """corners are looked up once, whatever the number of boxes that have them; boxes of a name add up."""
    obs = td.obs(spark, SF001)
    boxes = [(f"z{i:03}", 10 * (i % 9) - i % 5, 10 * (i % 9) + 205, 100, 300 + i % 7) for i in range(300)]
    boxes += boxes[:3] + [("z004", 900, 5000, 900, 6000), ("two", 0, 300, 0, 400), ("two", 0, 90, 0, 90), ("out", -50, -3, 0, 500)]
    boxes = spark.createDataFrame(boxes, ZONE_BOXES)
    same(moments.zone_moments(obs, boxes), measures(obs, boxes))
    sums = moments.PrefixSums(obs)
    asked = []
    at = sums.at
    sums.at = lambda corners: asked.append(corners.count()) or at(corners)
    moments.zone_moments(sums, boxes).collect()
    assert asked[0] < 100
