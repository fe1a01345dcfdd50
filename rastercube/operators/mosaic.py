"""Tiles as a dimension: zone boxes per tile, and tiles laid onto one pixel grid.

A ``tiles`` table (``schema.TILES``) gives each tile's top-left corner in
projected metres, its pixel size and its extent.  All its tiles are in one
projection.  Pixels that two overlapping tiles both hold are pixels of both
tiles; ``to_mosaic`` brings them to the same place, where a block mean
averages them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastercube.operators.zones import with_utm

# Fixed value: how a product name carries its tile's code.
TILE_CODE = r"(?:^|_)(T[0-9]{2}[A-Z]{3})(?:_|\.|$)"
MAX_BROADCAST_TILES = 100_000


def tile_code(name: str) -> Column:
    """The tile's code in a product name, NULL if it has none."""
    code = F.regexp_extract(F.col(name), TILE_CODE, 1)
    return F.when(code != "", code)


def _in_cells(df: DataFrame, x0: str, x1: str, y0: str, y1: str, cell: float) -> DataFrame:
    """A row for each cell of ``cell`` metres that the rectangle touches."""
    for name, lo, hi in (("_cx", x0, x1), ("_cy", y0, y1)):
        df = df.withColumn(name, F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell))))
    return df


def zone_tile_boxes(zones: DataFrame, tiles: DataFrame, utm_zone: int = 33, cell: float = 100_000.0) -> DataFrame:
    """``zone, tile_id, row_min, row_max, col_min, col_max``: a zone's box in every tile that it reaches.

    Zones and tiles meet by the coarse cells that both touch, each pair in
    one cell only; boxes are cut to the tile (inclusive native pixels), and a
    zone outside all tiles, or without a centre, gives no row.
    """
    r = F.col("radius_km").cast("double") * 1000.0
    z = with_utm(zones, zone=utm_zone).select(
        "zone", (F.col("easting") - r).alias("x0"), (F.col("easting") + r).alias("x1"),
        (F.col("northing") - r).alias("y0"), (F.col("northing") + r).alias("y1"))
    t = tiles.select(
        "tile_id", "pixel_size", "n_rows", "n_cols", F.col("origin_x").alias("tx0"),
        (F.col("origin_x") + F.col("n_cols") * F.col("pixel_size")).alias("tx1"),
        (F.col("origin_y") - F.col("n_rows") * F.col("pixel_size")).alias("ty0"), F.col("origin_y").alias("ty1"))
    met = _in_cells(z, "x0", "x1", "y0", "y1", cell).join(_in_cells(t, "tx0", "tx1", "ty0", "ty1", cell), ["_cx", "_cy"])
    met = met.where((F.col("_cx") == F.floor(F.greatest("x0", "tx0") / cell))
                    & (F.col("_cy") == F.floor(F.greatest("y0", "ty0") / cell)))

    def pixel(metres: Column) -> Column:
        return F.floor(metres / F.col("pixel_size")).cast("int")

    boxes = met.select(
        "zone", "tile_id",
        F.greatest(pixel(F.col("ty1") - F.col("y1")), F.lit(0)).alias("row_min"),
        F.least(pixel(F.col("ty1") - F.col("y0")), F.col("n_rows") - 1).alias("row_max"),
        F.greatest(pixel(F.col("x0") - F.col("tx0")), F.lit(0)).alias("col_min"),
        F.least(pixel(F.col("x1") - F.col("tx0")), F.col("n_cols") - 1).alias("col_max"))
    return boxes.where("row_min <= row_max and col_min <= col_max")


def to_mosaic(obs: DataFrame, tiles: DataFrame) -> DataFrame:
    """``obs`` with ``row``/``col`` counted from the top-left corner of all ``tiles``.

    Tiles must share one pixel size and lie whole pixels apart; an observation
    of an unknown tile is an error.
    """
    e = tiles.agg(F.min("origin_x").alias("x"), F.max("origin_y").alias("y"), F.min("pixel_size").alias("p"),
                  F.max("pixel_size").alias("q"), F.count(F.lit(1)).alias("n")).first()
    if e.n == 0:
        raise ValueError("no tiles")
    if e.p != e.q:
        raise ValueError("tiles of different pixel sizes have no common grid")
    down, right = (F.lit(e.y) - F.col("origin_y")) / e.p, (F.col("origin_x") - F.lit(e.x)) / e.p
    if tiles.where((F.abs(down - F.round(down)) > 1e-6) | (F.abs(right - F.round(right)) > 1e-6)).limit(1).count():
        raise ValueError("tiles must lie whole pixels apart")
    shift = tiles.select("tile_id", F.round(down).cast("int").alias("_down"), F.round(right).cast("int").alias("_right"))
    if e.n <= MAX_BROADCAST_TILES:
        shift = F.broadcast(shift)
    known = F.when(F.col("_down").isNull(), F.raise_error(F.concat(
        F.lit("no such tile: "), F.coalesce("tile_id", F.lit("NULL")))).cast("int")).otherwise(F.col("_down"))
    moved = obs.join(shift, "tile_id", "left").withColumn("row", F.col("row") + known).withColumn(
        "col", F.col("col") + F.col("_right"))
    return moved.select(*obs.columns)
