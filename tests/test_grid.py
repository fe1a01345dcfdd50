
import pytest
from pyspark.sql import functions as F

from fixtures import SF001
from fixtures import obs_df
from rastercube.operators import grid
from rastercube.sources import testdata as td


def _plane(cube, t):
    rows = cube.filter(F.col("t") == t).collect()
    n_r = max(r.row_ds for r in rows) + 1
    n_c = max(r.col_ds for r in rows) + 1
    out = [[None] * n_c for _ in range(n_r)]
    for r in rows:
        out[r.row_ds][r.col_ds] = None if r.value is None else round(r.value, 6)
    return out


def test_dense_cube_golden_block10(spark):
    means = grid.block_means(obs_df(spark), 10)
    cube = grid.dense_cube(means)
    assert cube.count() == 2 * 2 * 2
    assert _plane(cube, 0) == [[0.5, 0.0], [-0.5, None]]
    assert _plane(cube, 1) == [[0.0, None], [0.6, None]]
    dates = [r.date for r in grid.time_axis(means).orderBy("t").collect()]
    assert dates == ["2024-01-05", "2024-03-05"]


def test_block20_and_identity(spark):
    m20 = {r.date: r.ndvi_mean for r in grid.block_means(obs_df(spark), 20).collect()}
    assert m20["2024-01-05"] == pytest.approx(0.0, abs=1e-7)
    assert m20["2024-03-05"] == pytest.approx(0.3, abs=1e-7)
    # block 10 over native steps of 10 keeps every pixel: identity
    m10 = grid.block_means(obs_df(spark), 10)
    assert m10.count() == obs_df(spark).count()


def test_dense_invariants_and_series(spark):
    o = td.obs(spark, SF001)
    means = grid.block_means(o, 20)
    cube = grid.dense_cube(means)
    ext = grid.cube_extent(means).first()
    assert grid.extent_from_obs(o, 20) == (ext.n_rows, ext.n_cols, ext.n_dates)
    assert cube.count() == ext.n_rows * ext.n_cols * ext.n_dates
    assert cube.filter(F.col("value").isNotNull()).count() == means.count()
    series = grid.cube_series(cube)
    assert series.count() == ext.n_rows * ext.n_cols
    direct = grid.series_from_means(means)
    assert sorted((r.row_ds, r.col_ds, tuple(r.series)) for r in direct.collect()) == sorted(
        (r.row_ds, r.col_ds, tuple(r.series)) for r in series.collect()
    )
    back = series.select("row_ds", "col_ds", F.posexplode("series").alias("t", "value"))
    a = sorted((r.row_ds, r.col_ds, r.t, r.value) for r in back.collect())
    b = sorted((r.row_ds, r.col_ds, r.t, r.value) for r in cube.collect())
    assert a == b


def test_crop_stride_fill_clamp(spark):
    means = grid.block_means(obs_df(spark), 10)
    cube = grid.dense_cube(means)
    crop = grid.cube_crop(cube, 0, 1, 1, 99)  # past the end is fine
    assert sorted((r.row_ds, r.col_ds) for r in crop.collect()) == [(0, 1), (0, 1)]
    st = grid.cube_stride(cube, 2, 0, 0).collect()
    assert {(r.x, r.y) for r in st} == {(0, 0)}
    filled = grid.cube_fill_zero(cube)
    assert filled.filter(F.col("value").isNull()).count() == 0
    assert filled.filter(F.col("value") == 0).count() == 3 + 2  # 3 missing cells + 2 real zero means
    scaled = grid.cube_display_scale(cube).collect()
    vals = [r.value for r in scaled if r.value is not None]
    assert min(vals) == pytest.approx(-0.2) and max(vals) <= 0.8
    assert sum(r.value is None for r in scaled) == 3


def test_block_resample_full_blocks_only(spark):
    bands = spark.createDataFrame(
        [(0, r, c, float(r * 10 + c)) for r in range(5) for c in range(7)], "k int, row int, col int, value double"
    )
    out = {(r.row_ds, r.col_ds): r.value for r in grid.block_resample(bands, 2, ["k"]).collect()}
    assert set(out) == {(i, j) for i in range(2) for j in range(3)}
    assert out[(0, 0)] == pytest.approx((0 + 1 + 10 + 11) / 4)
    r = grid.block_resample(bands.withColumn("value", F.col("value") + 0.25), 2, ["k"], round_result=True).collect()
    assert all(float(x.value).is_integer() for x in r)


def test_raster_explode(spark):
    strips = spark.createDataFrame([(0, 0, [1.0, 0.0, 2.0]), (0, 1, [0.0, 0.0, 3.0])], "k int, row int, values array<float>")
    got = sorted(tuple(r) for r in grid.raster_explode(strips, ["k"], step=10).collect())
    assert got == [(0, 0, 0, 1.0), (0, 0, 20, 2.0), (0, 10, 20, 3.0)]


def test_block_means_keep_tiles_apart(spark):
    rows = [("t1", "d", 0, 0, 0.2), ("t2", "d", 0, 0, 0.6)]
    o = spark.createDataFrame(rows, "tile_id string, date string, row int, col int, ndvi float")
    pooled = grid.block_means(o, 10).collect()
    assert len(pooled) == 1 and pooled[0].ndvi_mean == pytest.approx(0.4)
    apart = {r.tile_id: r.ndvi_mean for r in grid.block_means(o, 10, by=["tile_id"]).collect()}
    assert apart == {"t1": pytest.approx(0.2), "t2": pytest.approx(0.6)}


def test_band_regrid_of_a_tall_band(spark):
    """a row times the target's height passes 32 bits."""
    height = 200_000
    rows = [0, 1, 2, 123_456, height - 2, height - 1]
    bands = spark.createDataFrame([(0, r, 0, float(i)) for i, r in enumerate(rows)], "k int, row int, col int, value float")
    got = {r.row_ds: r.value for r in grid.band_regrid(bands, ["k"], height, 1, height * 2 // 5, 1).collect()}
    # cells of 2.5 rows: row 2 lies half in cell 0 and half in cell 1
    assert got == {0: pytest.approx((0 + 1 + 0.5 * 2) / 2.5), 1: pytest.approx(2.0), 49_382: pytest.approx(3.0),
                   79_999: pytest.approx((4 + 5) / 2)}
