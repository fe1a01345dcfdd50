import os

import pytest
from pyspark.sql import functions as F

from rastercube.operators import grid, mosaic, zones
from rastercube.plans import job
from rastercube.schema import TILES
from rastercube.sources import store

OBS = "tile_id string, date string, row int, col int, red float, nir float, ndvi float"
EAST, NORTH = 308769.810, 4624576.159  # the projected centre of the third reference zone


def _tiles(spark):
    """Two tiles side by side; the zone's centre lies on their common edge."""
    return spark.createDataFrame(
        [("T33TTG", EAST - 1000.0, NORTH + 500.0, 10.0, 100, 100), ("T33TUG", EAST, NORTH + 500.0, 10.0, 100, 100),
         ("T33TVG", EAST + 900_000.0, NORTH, 10.0, 100, 100)], TILES)


def _obs(spark):
    rows = [(t, d, r, c, 1.0, 1.0, v) for d, k in (("2024-01-05", 0.0), ("2024-02-05", 0.1))
            for t, r, c, v in (("T33TTG", 0, 0, 0.1 + k), ("T33TTG", 50, 95, 0.2 + k), ("T33TUG", 50, 4, 0.4 + k),
                               ("T33TUG", 90, 99, 0.5 + k))]
    rows.append(("T33TUG", "2024-03-05", 50, 0, 1.0, 1.0, 0.9))
    return spark.createDataFrame(rows, OBS)


def test_tile_code(spark):
    names = ["S2A_MSIL2A_20240105T100401_N0510_R122_T33TTG_20240105T140000", "T33TUG", "S2_T33TTG.SAFE", "plain", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r[0] for r in df.select(mosaic.tile_code("name")).collect()] == ["T33TTG", "T33TUG", "T33TTG", None, None]


def test_zone_box_is_cut_at_the_tiles_it_reaches(spark):
    z = zones.reference_zones(spark).where("zone = 'Castelli Romani'").withColumn("radius_km", F.lit(0.205))
    got = {r.tile_id: (r.row_min, r.row_max, r.col_min, r.col_max) for r in mosaic.zone_tile_boxes(z, _tiles(spark)).collect()}
    assert got == {"T33TTG": (29, 70, 79, 99), "T33TUG": (29, 70, 0, 20)}
    # the same pairs whatever the cells are
    for cell in (300.0, 7_000.0, 1e7):
        again = mosaic.zone_tile_boxes(z, _tiles(spark), cell=cell).collect()
        assert {r.tile_id: tuple(r)[2:] for r in again} == got and len(again) == 2
    lost = z.withColumn("lat", F.lit(None).cast("double"))
    assert mosaic.zone_tile_boxes(lost, _tiles(spark)).count() == 0


def test_strategies_agree_on_tile_boxes(spark):
    z = zones.reference_zones(spark).where("zone = 'Castelli Romani'").withColumn("radius_km", F.lit(0.2))
    boxes, o = mosaic.zone_tile_boxes(z, _tiles(spark)), _obs(spark)
    want = None
    for strategy in ("inline", "cells", "union"):
        got = sorted((r.zone, r.date, round(r.ndvi_mean, 6), r.pixel_count)
                     for r in zones.zone_stats(o, boxes, strategy=strategy).collect())
        want = want or got
        assert got == want
    assert [(d, n) for _, d, _, n in want] == [("2024-01-05", 2), ("2024-02-05", 2), ("2024-03-05", 1)]
    assert [m for _, _, m, _ in want] == [pytest.approx(x, abs=1e-5) for x in (0.3, 0.4, 0.9)]
    apart = zones.zone_stats(o, boxes, by=["tile_id"]).collect()
    assert [(r.tile_id, r.date, r.pixel_count) for r in apart] == [
        ("T33TTG", "2024-01-05", 1), ("T33TTG", "2024-02-05", 1), ("T33TUG", "2024-01-05", 1), ("T33TUG", "2024-02-05", 1),
        ("T33TUG", "2024-03-05", 1)]


def test_to_mosaic(spark):
    tiles = _tiles(spark).where("tile_id != 'T33TVG'")
    got = {(r.tile_id, r.row, r.col) for r in mosaic.to_mosaic(_obs(spark), tiles).where("date = '2024-01-05'").collect()}
    assert got == {("T33TTG", 0, 0), ("T33TTG", 50, 95), ("T33TUG", 50, 104), ("T33TUG", 90, 199)}
    with pytest.raises(Exception, match="no such tile"):
        mosaic.to_mosaic(_obs(spark), tiles.where("tile_id = 'T33TTG'")).collect()
    with pytest.raises(ValueError, match="whole pixels"):
        mosaic.to_mosaic(_obs(spark), tiles.withColumn("origin_x", F.when(F.col("tile_id") == "T33TTG", 3.3).otherwise(10.0)))
    with pytest.raises(ValueError, match="pixel sizes"):
        mosaic.to_mosaic(_obs(spark), tiles.withColumn("pixel_size", F.when(F.col("tile_id") == "T33TTG", 3.0).otherwise(10.0)))
    with pytest.raises(ValueError, match="no tiles"):
        mosaic.to_mosaic(_obs(spark), tiles.limit(0))


def test_series_and_cube_by_tile(spark):
    means = grid.block_means(_obs(spark), 50, by=["tile_id"])
    cube = grid.dense_cube(means, by=["tile_id"])
    assert cube.count() == (2 + 3) * 2 * 2  # a plane for each tile and date that there is
    got = {(r.tile_id, r.row_ds, r.col_ds): r.series for r in grid.series_from_means(means, by=["tile_id"]).collect()}
    assert len(got) == 8
    near = lambda xs: [None if x is None else round(x, 4) for x in xs]
    assert near(got["T33TUG", 1, 0]) == [0.4, 0.5, 0.9] and near(got["T33TUG", 1, 1]) == [0.5, 0.6, None]
    assert got["T33TTG", 0, 1] == [None] * 3
    stored = {(r.tile_id, r.row_ds, r.col_ds): r.series for r in grid.cube_series(cube, by=["tile_id"]).collect()}
    assert stored == got
    empty = means.limit(0)
    assert grid.dense_cube(empty, by=["tile_id"]).columns == cube.columns
    assert grid.series_from_means(empty, by=["tile_id"]).count() == 0


def test_series_gaps_and_repeats(spark):
    rows = [(d, 0, 0, v) for d, v in (("b", 2.0), ("d", 4.0))] + [("a", 0, 1, 1.0), ("c", 0, 2, 3.0)]
    df = spark.createDataFrame(rows, "date string, row_ds int, col_ds int, ndvi_mean double")
    got = {r.col_ds: r.series for r in grid.series_from_means(df).collect()}
    assert got == {0: [None, 2.0, None, 4.0], 1: [1.0, None, None, None], 2: [None, None, 3.0, None]}
    with pytest.raises(Exception, match="two values of one cell"):
        grid.series_from_means(df.union(df)).collect()


def test_job_on_two_tiles(spark, tmpdir_path):
    obs = _obs(spark).withColumn("tile_id", F.concat(F.lit("S2A_MSIL2A_"), F.col("tile_id"), F.lit("_x")))
    with pytest.raises(ValueError, match="several tiles"):
        job.run(spark, obs, os.path.join(tmpdir_path, "no"))
    with pytest.raises(ValueError, match="not in the tile dimension"):
        job.run(spark, obs, os.path.join(tmpdir_path, "few"), tiles=_tiles(spark).where("tile_id = 'T33TTG'"))
    out = os.path.join(tmpdir_path, "out")
    job.run(spark, obs, out, tiles=_tiles(spark), block=50, crop=(0, 2, 0, 2), stride=1)
    cube, dates = store.read_cube(spark, os.path.join(out, "cube"), with_tile=True)
    assert dates.count() == 3 and cube.count() == 20 and cube.select("tile_id").distinct().count() == 2
    # the zone of five kilometres covers both tiles; the other zones reach none
    zs = store.read_stats_csv(spark, os.path.join(out, "zone_stats"), zones=True, parse_dates=False).collect()
    assert {(r.zone, r.date, r.pixel_count) for r in zs} == {
        ("Castelli Romani", "2024-01-05", 4), ("Castelli Romani", "2024-02-05", 4), ("Castelli Romani", "2024-03-05", 1)}
    assert "tile_id" in spark.read.parquet(os.path.join(out, "mesh")).columns
