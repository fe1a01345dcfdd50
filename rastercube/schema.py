"""Fixed table schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# One row per valid pixel per acquisition date.  ``row``/``col`` are native
# 10 m pixel indices of the top-left corner of each read block.
OBSERVATION = StructType(
    [
        StructField("date", StringType(), False),
        StructField("row", IntegerType(), False),
        StructField("col", IntegerType(), False),
        StructField("red", FloatType(), True),
        StructField("nir", FloatType(), True),
        StructField("ndvi", FloatType(), True),
    ]
)

# Same, with the tile the pixel came from (two tiles on one date stay apart).
TILE_OBSERVATION = StructType([StructField("tile_id", StringType(), False)] + OBSERVATION.fields)

STAT_FIELDS = [
    StructField("ndvi_mean", DoubleType(), True),
    StructField("ndvi_std", DoubleType(), True),
    StructField("ndvi_p25", DoubleType(), True),
    StructField("ndvi_p75", DoubleType(), True),
    StructField("pixel_count", LongType(), False),
]

DATE_STATS = StructType([StructField("date", StringType(), False)] + STAT_FIELDS)
ZONE_STATS = StructType(
    [StructField("zone", StringType(), False), StructField("date", StringType(), False)]
    + STAT_FIELDS
)

BLOCK_MEANS = StructType(
    [
        StructField("date", StringType(), False),
        StructField("row_ds", IntegerType(), False),
        StructField("col_ds", IntegerType(), False),
        StructField("ndvi_mean", DoubleType(), True),
    ]
)

# Acquisition manifest written by the selection step and read by the loader.
MANIFEST = StructType(
    [
        StructField("id", StringType(), True),
        StructField("name", StringType(), True),
        StructField("date", StringType(), True),
        StructField("cloud_cover", DoubleType(), True),
        StructField("path", StringType(), True),
    ]
)

ATTRIBUTE = StructType([StructField("Name", StringType(), True), StructField("Value", StringType(), True)])
POINT = StructType([StructField("x", DoubleType(), True), StructField("y", DoubleType(), True)])

# Catalogue product as returned by the product search service.
CATALOG_PRODUCT = StructType(
    [
        StructField("Id", StringType(), True),
        StructField("Name", StringType(), True),
        StructField("Collection", StringType(), True),
        StructField("ContentDate", StructType([StructField("Start", StringType(), True)]), True),
        StructField("Attributes", ArrayType(ATTRIBUTE), True),
        StructField("Footprint", ArrayType(POINT), True),
    ]
)

ZONES = StructType(
    [
        StructField("zone", StringType(), False),
        StructField("lon", DoubleType(), False),
        StructField("lat", DoubleType(), False),
        StructField("radius_km", DoubleType(), False),
    ]
)

ZONE_BOXES = StructType(
    [
        StructField("zone", StringType(), False),
        StructField("row_min", IntegerType(), False),
        StructField("row_max", IntegerType(), False),
        StructField("col_min", IntegerType(), False),
        StructField("col_max", IntegerType(), False),
    ]
)

# The tile dimension: top-left corner and pixel size in projected metres, extent in native pixels.
TILES = StructType(
    [
        StructField("tile_id", StringType(), False),
        StructField("origin_x", DoubleType(), False),
        StructField("origin_y", DoubleType(), False),
        StructField("pixel_size", DoubleType(), False),
        StructField("n_rows", IntegerType(), False),
        StructField("n_cols", IntegerType(), False),
    ]
)

ARCHIVE_LISTING = StructType(
    [
        StructField("archive", StringType(), False),
        StructField("ordinal", IntegerType(), True),
        StructField("member", StringType(), True),
        StructField("readable", BooleanType(), False),
    ]
)
