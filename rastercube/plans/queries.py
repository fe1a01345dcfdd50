"""Registered parity queries: ``(spark, sf_dir) -> DataFrame``.

Each query maps the driver's tables onto raster tables (``sources.testdata``)
and runs one operator over the whole tables.  The DuckDB twin of every query
is in ``plans.oracle``; column names match one for one.  Aggregated doubles
are rounded to 6 digits on both sides because the engines add in different
orders.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rastercube.functions import morton
from rastercube.functions.columns import normalized_difference
from rastercube.functions.paths import resolve_path
from rastercube.operators import catalog as cat
from rastercube.operators import grid, moments, mosaic, zones
from rastercube.operators.stats import date_stats, observation_count
from rastercube.operators.bands import valid_mask
from rastercube.session import checkpoint_dir
from rastercube.sources import store
from rastercube.sources import testdata as td
from rastercube.sources.archives import resolve_bands

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the parity queries.
CUBE_BLOCK = 20  # native pixels per cube cell in the test mapping (grid 50 x 50)
CROP = (0, 40, 11, 50)  # rows [0, 40), cols [11, 50) in cells
STRIDE = 6
SLICE_T = 5
BBOX = (200, 600, 100, 450)
ZONE_CELL = 250
RESAMPLE_BLOCK = 3
POINT = (12.5, 41.9)
N_FILL = 20  # more than the target months, so that the fill branch works on the whole catalogue
MAX_CLOUD = 20.0
SEARCH_WINDOW = ("1996-01-01", "1997-12-31")


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column (parity only)."""
    return df.select(
        *[F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
          for f in df.schema.fields]
    )


# ---- observations and statistics -------------------------------------------------

def q_ndvi_project(spark, d):
    return td.obs(spark, d)


def q_ndvi_guarded(spark, d):
    r = td.raw_obs(spark, d)
    return r.select("date", "row", "col", "red", "nir", normalized_difference("nir", "red").alias("ndvi"))


def q_valid_mask(spark, d):
    r = td.raw_obs(spark, d)
    return r.groupBy("date").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count(F.when(valid_mask("red", "nir"), 1)).alias("n_valid"),
    )


def q_obs_count(spark, d):
    return observation_count(td.obs(spark, d))


def q_date_stats(spark, d):
    return r6(date_stats(td.obs(spark, d)))


def q_date_stats_approx(spark, d):
    """Approximate quartiles, checked in the query: each must have a rank within one percent of its own."""
    obs = td.obs(spark, d)
    stats = date_stats(obs, method="approx")
    below = [F.avg((F.col("ndvi") < F.col(p)).cast("int")).alias(f"lt_{p}") for p in ("ndvi_p25", "ndvi_p75")]
    upto = [F.avg((F.col("ndvi") <= F.col(p)).cast("int")).alias(f"le_{p}") for p in ("ndvi_p25", "ndvi_p75")]
    ranks = obs.join(stats.select("date", "ndvi_p25", "ndvi_p75"), "date").groupBy("date").agg(*below, *upto)
    return r6(stats.join(ranks, "date").select(
        "date", "ndvi_mean", "ndvi_std", "pixel_count",
        *[((F.col(f"lt_{p}") <= q + 0.01) & (F.col(f"le_{p}") >= q - 0.01)).alias(f"{p}_near")
          for p, q in (("ndvi_p25", 0.25), ("ndvi_p75", 0.75))]))


# ---- zones --------------------------------------------------------------------------

def customer_boxes(spark, d) -> DataFrame:
    """100 and more overlapping boxes from ``customer``, named by key."""
    k = F.col("c_custkey").cast("int")
    return td.table(spark, d, "customer", ["c_custkey"]).select(
        F.concat(F.lit("z"), k.cast("string")).alias("zone"), ((k * 37) % 900).alias("row_min"),
        ((k * 37) % 900 + 20).alias("row_max"), ((k * 53) % 900).alias("col_min"), ((k * 53) % 900 + 30).alias("col_max"))


def q_date_and_zone_stats(spark, d):
    by_date, by_zone = zones.date_and_zone_stats(td.obs(spark, d), customer_boxes(spark, d))
    return r6(by_zone.unionByName(by_date.withColumn("zone", F.lit("*"))))



def q_zone_moments(spark, d):
    return r6(moments.zone_moments(td.obs(spark, d), customer_boxes(spark, d)))


def q_zone_stats(spark, d):
    return r6(zones.zone_stats(td.obs(spark, d), td.test_boxes(spark), strategy="inline"))


def q_zone_stats_cells(spark, d):
    return r6(zones.zone_stats(td.obs(spark, d), td.test_boxes(spark), strategy="cells", cell=ZONE_CELL))


def q_zone_stats_union(spark, d):
    return r6(zones.zone_stats(td.obs(spark, d), td.test_boxes(spark), strategy="union"))


def q_zone_utm(spark, d):
    z = zones.with_utm(td.customer_zones(spark, d))
    return z.select("zone", F.round("easting", 3).alias("easting"), F.round("northing", 3).alias("northing"))


def q_zone_bounds(spark, d):
    return zones.zone_pixel_bounds(td.customer_zones(spark, d))


def q_bbox_filter(spark, d):
    return zones.bbox_filter(td.obs(spark, d), *BBOX).select("date", "row", "col", "ndvi")


def q_morton_key(spark, d):
    return td.obs(spark, d).select("date", "row", "col", morton.morton_key().alias("z"))


def q_bbox_filter_clustered(spark, d):
    """The box, read by key ranges from a store that is written for it."""
    path = f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"
    store.write_observations(td.obs(spark, d), path, clustered=True)
    found = zones.bbox_filter(store.read_observations(spark, path, clustered=True), *BBOX)
    return found.select("date", "row", "col", "ndvi")


def _zone_stats_small(spark, d):
    return zones.zone_stats(td.obs(spark, d), td.test_boxes(spark))


def q_zone_pivot(spark, d):
    return zones.zone_pivot(_zone_stats_small(spark, d))


def q_zone_error_bars(spark, d):
    return r6(zones.zone_error_bars(_zone_stats_small(spark, d)))


def q_zone_series(spark, d):
    return r6(zones.zone_series(_zone_stats_small(spark, d)))


# ---- several tiles ----------------------------------------------------------------------

def q_zone_tile_boxes(spark, d):
    return mosaic.zone_tile_boxes(td.customer_zones(spark, d), td.test_tiles(spark))


def q_zone_stats_by_tile(spark, d):
    return r6(zones.zone_stats(td.obs(spark, d, tile=True), q_zone_tile_boxes(spark, d), by=["tile_id"]))


def q_zone_stats_tiles(spark, d):
    """A zone's pixels in all tiles that it reaches, together."""
    return r6(zones.zone_stats(td.obs(spark, d, tile=True), q_zone_tile_boxes(spark, d)))


def _tile_means(spark, d):
    return grid.block_means(td.obs(spark, d, tile=True), CUBE_BLOCK, by=["tile_id"])


def q_cube_dense_by_tile(spark, d):
    return grid.dense_cube(_tile_means(spark, d), by=["tile_id"])


def q_cube_series_by_tile(spark, d):
    return grid.series_from_means(_tile_means(spark, d), by=["tile_id"])


def q_mosaic_block_mean(spark, d):
    return r6(grid.block_means(mosaic.to_mosaic(td.obs(spark, d, tile=True), td.test_tiles(spark)), CUBE_BLOCK))


# ---- grid and cube ---------------------------------------------------------------------

def _means(spark, d):
    return grid.block_means(td.obs(spark, d), CUBE_BLOCK)


def q_cube_block_mean(spark, d):
    return r6(_means(spark, d))


def q_cube_extent(spark, d):
    return grid.cube_extent(_means(spark, d))


def q_time_axis(spark, d):
    return grid.time_axis(td.obs(spark, d))


def q_cube_time_index(spark, d):
    return r6(grid.with_time_index(_means(spark, d)))


def _dense(spark, d):
    return grid.dense_cube(_means(spark, d))


def q_cube_dense(spark, d):
    return _dense(spark, d)


def q_cube_slice(spark, d):
    return grid.cube_slice(_dense(spark, d), SLICE_T)


def q_cube_series(spark, d):
    return grid.series_from_means(_means(spark, d))


def q_cube_crop(spark, d):
    return grid.cube_crop(_dense(spark, d), *CROP)


def q_cube_stride(spark, d):
    c = grid.cube_crop(_dense(spark, d), *CROP)
    return grid.cube_stride(c, STRIDE, CROP[0], CROP[2])


def q_cube_fill_zero(spark, d):
    return r6(grid.cube_fill_zero(_dense(spark, d)))


def q_cube_display_scale(spark, d):
    return r6(grid.cube_display_scale(_dense(spark, d)))


def q_block_resample(spark, d):
    return grid.block_resample(td.raster(spark, d), RESAMPLE_BLOCK, ["label"])


def q_band_regrid(spark, d):
    """The embeddings as a band of 64 columns, averaged onto 24 columns and 4 rows for each 10."""
    raster = td.raster(spark, d)
    height = raster.agg(F.max("row")).first()[0] + 1
    return r6(grid.band_regrid(raster, ["label"], height, 64, height * 2 // 5, 24))


def q_raster_explode(spark, d):
    e = td.table(spark, d, "embeddings").select("label", F.col("vec_id").cast("int").alias("row"), F.col("embedding").alias("values"))
    return grid.raster_explode(e, ["label"], step=10)


# ---- sources: path mapping and band resolution ----------------------------------

def archive_paths(spark, d) -> DataFrame:
    o = td.table(spark, d, "orders", ["o_orderkey", "o_orderstatus"])
    k = F.col("o_orderkey").cast("string")
    path = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("C:\\data\\raw\\S2_"), k, F.lit(".zip")))
        .when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("d:/tiles/"), F.col("o_orderstatus"), F.lit("\\S2_"), k, F.lit(".zip")))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("/mnt/e/raw/S2_"), k, F.lit(".zip")))
        .when(F.col("o_orderkey") % 8 == 3, F.concat(F.lit("C:S2_"), k, F.lit(".zip")))
        .otherwise(F.concat(F.lit("S2_"), k, F.lit(".zip")))
    )
    return o.select(path.alias("path"))


def q_path_resolve(spark, d):
    p = archive_paths(spark, d)
    return p.select("path", resolve_path("path").alias("local_path"), resolve_path("path", "/data/raw").alias("pod_path"))


def member_listing(spark, d) -> DataFrame:
    li = td.table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    s = F.col("l_suppkey").cast("string")
    g = F.concat(F.lit("S2.SAFE/GRANULE/L2A_"), s)
    m = F.col("l_partkey") % 6
    member = (
        F.when(m == 0, F.concat(g, F.lit("/IMG_DATA/R10m/T33TTG_"), s, F.lit("_B04_10m.jp2")))
        .when(m == 1, F.concat(g, F.lit("/IMG_DATA/R20m/T33TTG_"), s, F.lit("_B04_20m.jp2")))
        .when(m == 2, F.concat(g, F.lit("/IMG_DATA/R10m/T33TTG_"), s, F.lit("_B08_10m.jp2")))
        .when(m == 3, F.concat(g, F.lit("/IMG_DATA/R60m/T33TTG_"), s, F.lit("_B08_60m.jp2")))
        .when(m == 4, F.concat(g, F.lit("/QI_DATA/MSK_CLDPRB_B04_20m.gml")))
        .otherwise(F.lit("S2.SAFE/MTD_MSIL2A.xml"))
    )
    return li.select(
        F.concat(F.lit("S2_"), F.col("l_orderkey").cast("string"), F.lit(".zip")).alias("archive"),
        F.col("l_linenumber").cast("int").alias("ordinal"),
        member.alias("member"),
        F.lit(True).alias("readable"),
    )


def q_band_resolve(spark, d):
    return resolve_bands(member_listing(spark, d), ["B04", "B08"], on_missing="null")


# ---- catalogue ---------------------------------------------------------------------------

def nested_catalog(spark, d) -> DataFrame:
    o = td.table(spark, d, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    tile = F.when(cust % 3 == 0, "T33TTG").when(cust % 3 == 1, "T33TUG").otherwise("T32TQM")
    name = F.concat(
        F.lit("S2"), F.when(cust % 2 == 0, "A").otherwise("B"), F.lit("_MSIL2A_"),
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), tile,
    )
    ptype = F.struct(F.lit("productType").alias("Name"), F.when(key % 4 == 0, "S2MSI1C").otherwise("S2MSI2A").alias("Value"))
    cc_val = F.concat(  # price / 10000 truncated to 2 decimals, integer arithmetic only
        F.expr("CAST(ROUND(o_totalprice * 100) AS BIGINT) DIV 10000").cast("string"),
        F.lit("."),
        F.lpad((F.expr("CAST(ROUND(o_totalprice * 100) AS BIGINT) % 10000 DIV 100")).cast("string"), 2, "0"),
    )
    attrs = (
        F.when(key % 7 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.array(ptype))
        .when(F.col("o_orderstatus") == "P", F.array(ptype, F.struct(F.lit("cloudCover").alias("Name"), F.lit(None).cast("string").alias("Value"))))
        .otherwise(F.array(ptype, F.struct(F.lit("cloudCover").alias("Name"), cc_val.alias("Value"))))
    )
    cx = F.lit(12.0) + (cust % 100).cast("double") / 100.0
    cy = F.lit(41.5) + (key % 100).cast("double") / 100.0
    h = 0.3

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    footprint = F.array(pt(cx - h, cy - h), pt(cx + h, cy - h + 0.1), pt(cx + h, cy + h), pt(cx - h + 0.05, cy + h))
    return o.select(
        key.cast("string").alias("Id"),
        name.alias("Name"),
        F.when(F.col("o_orderpriority").startswith("5"), "SENTINEL-1").otherwise("SENTINEL-2").alias("Collection"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("Start")).alias("ContentDate"),
        attrs.alias("Attributes"),
        footprint.alias("Footprint"),
    )


def q_cloud_cover_extract(spark, d):
    n = nested_catalog(spark, d)
    return n.select("Id", cat.cloud_cover().alias("cloud"))


def q_catalog_filter(spark, d):
    n = nested_catalog(spark, d).withColumn("start", F.to_timestamp("ContentDate.Start"))
    f = cat.catalog_filter(n, start_after=SEARCH_WINDOW[0], start_before=SEARCH_WINDOW[1], name_contains="T33TTG")
    return f.select("Id", "Name", F.col("ContentDate.Start").alias("start_iso"))


def q_footprint_contains(spark, d):
    n = nested_catalog(spark, d)
    return n.select("Id", cat.footprint_contains(*POINT).alias("inside"))


def q_acq_date_parts(spark, d):
    n = nested_catalog(spark, d).select("Id", F.col("ContentDate.Start").alias("start_iso"))
    return cat.date_parts(n).select("Id", "day", "month", "mmdd")


def q_catalog_by_month(spark, d):
    return r6(cat.by_month(td.catalog(spark, d)))


def q_month_best(spark, d):
    return cat.month_best(td.catalog(spark, d)).select("month", "id", "start", "cloud")


def q_catalog_max_cloud(spark, d):
    n = nested_catalog(spark, d).withColumn("start", F.to_timestamp("ContentDate.Start"))
    return cat.catalog_filter(n, max_cloud=MAX_CLOUD).select("Id", "Name")


def q_select_acquisitions(spark, d):
    return cat.select_acquisitions(td.catalog(spark, d)).select("id", "start", "month", "cloud")


def q_select_acquisitions_fill(spark, d):
    return cat.select_acquisitions(td.catalog(spark, d), n=N_FILL).select("id", "start", "month", "cloud")


QUERIES: dict[str, Query] = {
    "ndvi_project": q_ndvi_project,
    "ndvi_guarded": q_ndvi_guarded,
    "valid_mask": q_valid_mask,
    "obs_count": q_obs_count,
    "date_stats": q_date_stats,
    "date_stats_approx": q_date_stats_approx,
    "zone_stats": q_zone_stats,
    "zone_stats_cells": q_zone_stats_cells,
    "zone_stats_union": q_zone_stats_union,
    "date_and_zone_stats": q_date_and_zone_stats,
    "zone_moments": q_zone_moments,
    "morton_key": q_morton_key,
    "bbox_filter_clustered": q_bbox_filter_clustered,
    "zone_utm": q_zone_utm,
    "zone_bounds": q_zone_bounds,
    "bbox_filter": q_bbox_filter,
    "zone_pivot": q_zone_pivot,
    "zone_error_bars": q_zone_error_bars,
    "zone_series": q_zone_series,
    "zone_tile_boxes": q_zone_tile_boxes,
    "zone_stats_by_tile": q_zone_stats_by_tile,
    "zone_stats_tiles": q_zone_stats_tiles,
    "cube_dense_by_tile": q_cube_dense_by_tile,
    "cube_series_by_tile": q_cube_series_by_tile,
    "mosaic_block_mean": q_mosaic_block_mean,
    "cube_block_mean": q_cube_block_mean,
    "cube_extent": q_cube_extent,
    "time_axis": q_time_axis,
    "cube_time_index": q_cube_time_index,
    "cube_dense": q_cube_dense,
    "cube_slice": q_cube_slice,
    "cube_series": q_cube_series,
    "cube_crop": q_cube_crop,
    "cube_stride": q_cube_stride,
    "cube_fill_zero": q_cube_fill_zero,
    "cube_display_scale": q_cube_display_scale,
    "block_resample": q_block_resample,
    "band_regrid": q_band_regrid,
    "raster_explode": q_raster_explode,
    "path_resolve": q_path_resolve,
    "band_resolve": q_band_resolve,
    "cloud_cover_extract": q_cloud_cover_extract,
    "catalog_filter": q_catalog_filter,
    "catalog_max_cloud": q_catalog_max_cloud,
    "footprint_contains": q_footprint_contains,
    "acq_date_parts": q_acq_date_parts,
    "catalog_by_month": q_catalog_by_month,
    "month_best": q_month_best,
    "select_acquisitions": q_select_acquisitions,
    "select_acquisitions_fill": q_select_acquisitions_fill,
}
