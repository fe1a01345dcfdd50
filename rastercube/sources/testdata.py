"""Mapping views from the driver's generic test tables onto raster tables.

The imagery the reference reads is not available, so the parity queries map
the given tables onto the shapes the operators expect.  Each mapping is
written twice -- as DataFrame code here and as DuckDB SQL in
``plans.oracle`` -- with identical arithmetic.

``obs``     observations from ``lineitem`` (one row per line item)
``raster``  a one-band raster from ``embeddings`` (row = vec_id,
            col = array position, value = element, label = time step)
``catalog`` catalogue products from ``orders``
``zones``   zone dimension from ``customer`` (lon/lat/radius per customer)
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.operators.bands import valid_mask
from rastercube.functions.columns import normalized_difference


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def raw_obs(spark: SparkSession, sf_dir: str, tile: bool = False) -> DataFrame:
    """Unmasked observation candidates (date, row, col, red, nir), led by a ``tile_id`` from the supplier if wanted."""
    li = table(spark, sf_dir, "lineitem")
    tiles = [F.concat(F.lit("T"), (F.col("l_suppkey") % 4).cast("string")).alias("tile_id")] if tile else []
    return li.select(
        *tiles,
        F.date_format("l_shipdate", "yyyy-MM").alias("date"),
        ((F.col("l_orderkey") % 100) * 10).cast("int").alias("row"),
        ((F.col("l_partkey") % 100) * 10).cast("int").alias("col"),
        (F.col("l_quantity") * F.col("l_tax") * 1000).cast("float").alias("red"),
        (F.col("l_extendedprice") * F.col("l_discount") / 10).cast("float").alias("nir"),
    )


def obs(spark: SparkSession, sf_dir: str, tile: bool = False) -> DataFrame:
    """Masked observations with NDVI: the loader's output on the test tables."""
    r = raw_obs(spark, sf_dir, tile).filter(valid_mask("red", "nir"))
    return r.withColumn("ndvi", normalized_difference("nir", "red"))


# Fixed test tiles: two by two, 1,000 pixels of 100 m each way.
TEST_TILES = [(f"T{k}", 200000.0 + (k % 2) * 100000.0, 4750040.0 - (k // 2) * 100000.0, 100.0, 1000, 1000) for k in range(4)]


def test_tiles(spark: SparkSession) -> DataFrame:
    from rastercube.schema import TILES

    return spark.createDataFrame(TEST_TILES, TILES)


# Fixed test zones in native pixels, (row_min, row_max, col_min, col_max):
# overlap (A/B), past the edge (C), empty (OFF) and edge-column (EDGE) cases.
TEST_BOXES = [
    ("A", 0, 300, 0, 300),
    ("B", 200, 500, 200, 500),
    ("C", 900, 1900, 850, 2000),
    ("OFF", 5000, 6000, 0, 0),
    ("EDGE", 100, 600, 0, 0),
]


def test_boxes(spark: SparkSession) -> DataFrame:
    from rastercube.schema import ZONE_BOXES

    return spark.createDataFrame(TEST_BOXES, ZONE_BOXES)


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones derived from ``customer``: centres spread over the UTM 33N tile area."""
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    return c.select(
        F.col("c_name").alias("zone"),
        (F.lit(12.0) + (F.col("c_custkey") % 1000).cast("double") / 1000.0).alias("lon"),
        (F.lit(41.5) + (F.col("c_custkey") % 997).cast("double") / 1000.0).alias("lat"),
        ((F.col("c_nationkey") % 5) + 1).cast("double").alias("radius_km"),
    )


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band rows ``(label, row, col, value)`` by exploding embedding arrays."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("label"),
        F.col("vec_id").cast("int").alias("row"),
        F.posexplode("embedding").alias("col", "value"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat catalogue ``(id, start, month, cloud)`` from ``orders``.

    ``cloud`` is 50 (the "unknown" value) for finished orders, else
    ``o_totalprice / 10000``.
    """
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("start"),
        F.month("o_orderdate").cast("int").alias("month"),
        F.when(F.col("o_orderstatus") == "F", F.lit(50.0))
        .otherwise(F.col("o_totalprice") / 10000.0)
        .alias("cloud"),
    )
