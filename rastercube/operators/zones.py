"""Zones: centre + radius -> pixel box, pixel-to-zone membership, zone statistics.

Zones may overlap, so one pixel can count in several zones.  Membership is a
many-to-many range join; three plans give the same rows:

``inline``  boxes (a small, size-checked dimension) become one array-of-tags
            expression evaluated in the scan's own stage: one scan, no join,
            the union envelope of the boxes pushed into the Parquet scan
``cells``   each box is cut into coarse grid cells; observations equi-join on
            their cell (broadcast below a checked size, else a shuffled join
            that AQE can split when one cell is hot) with the range test kept
            as a residual -- for many zones; cells are as large as a typical box
``blocks``  (statistics only) the pixels of a block meet all the zones in it
            at once, see ``operators.zone_blocks`` -- for many zones, without
            a row for each pixel of each zone
``union``   one filtered scan per zone, unioned, then one aggregation (the
            reference's per-zone filters, kept as a cross-check)

Boxes with a ``tile_id`` (``mosaic.zone_tile_boxes``) hold pixels of that tile
only; boxes without one hold the pixels of those numbers in any tile.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions import morton
from rastercube.functions.geo import utm_columns
from rastercube.operators.stats import date_stats, five_measures
from rastercube.operators.zone_blocks import LISTS, block_measures
from rastercube.schema import ZONES

# The reference's zones (name, lon, lat, radius km) and the
# georeference it uses for its tile (origin easting/northing of the
# top-left corner, metres; pixel size, metres; tile size in native pixels).
REFERENCE_ZONES = [
    ("Centro Storico", 12.492, 41.893, 3.0),
    ("Villa Borghese", 12.492, 41.914, 2.0),
    ("Castelli Romani", 12.700, 41.750, 5.0),
    ("Agro Romano", 12.350, 41.850, 5.0),
]
TILE_ORIGIN_X = 300000.0
TILE_ORIGIN_Y = 4700040.0
PIXEL_SIZE = 10.0
TILE_PIXELS = 10980

MAX_INLINE_ZONES = 64
MAX_BROADCAST_CELLS = 1_000_000  # ~50 bytes per (zone, cell) row


def reference_zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REFERENCE_ZONES, ZONES)


def with_utm(zones: DataFrame, lon: str = "lon", lat: str = "lat", zone: int = 33) -> DataFrame:
    e, n = utm_columns(lon, lat, zone)
    return zones.withColumn("easting", e).withColumn("northing", n)


def zone_pixel_bounds(
    zones: DataFrame,
    origin_x: float = TILE_ORIGIN_X,
    origin_y: float = TILE_ORIGIN_Y,
    pixel: float = PIXEL_SIZE,
    width: int = TILE_PIXELS,
    height: int = TILE_PIXELS,
    off_tile: str = "clamp",
    utm_zone: int = 33,
) -> DataFrame:
    """``zone, row_min, row_max, col_min, col_max, off_tile`` (inclusive, native px).

    The box is the square of half-width ``radius_km`` around the projected
    centre; rows grow southward.  Bounds are truncated toward zero.
    ``off_tile="clamp"`` clamps below at 0 and never above (the reference's
    behaviour: a box west of the tile collapses onto column 0);
    ``off_tile="drop"`` intersects with the tile and drops empty boxes.
    ``off_tile`` (column) flags a box not wholly inside the tile.
    """
    z = with_utm(zones, zone=utm_zone)
    r = F.col("radius_km").cast("double") * 1000.0
    cx, cy = F.col("easting"), F.col("northing")
    raw = {
        "row_min": ((F.lit(origin_y) - (cy + r)) / pixel).cast("int"),
        "row_max": ((F.lit(origin_y) - (cy - r)) / pixel).cast("int"),
        "col_min": ((cx - r - F.lit(origin_x)) / pixel).cast("int"),
        "col_max": ((cx + r - F.lit(origin_x)) / pixel).cast("int"),
    }
    outside = (
        (raw["row_min"] < 0) | (raw["col_min"] < 0) | (raw["row_max"] >= height) | (raw["col_max"] >= width)
    )
    if off_tile == "clamp":
        cols = {k: F.greatest(v, F.lit(0)) for k, v in raw.items()}
        out = z.select("zone", *[cols[k].alias(k) for k in cols], outside.alias("off_tile"))
        return out
    if off_tile == "drop":
        cols = {
            "row_min": F.greatest(raw["row_min"], F.lit(0)),
            "row_max": F.least(raw["row_max"], F.lit(height - 1)),
            "col_min": F.greatest(raw["col_min"], F.lit(0)),
            "col_max": F.least(raw["col_max"], F.lit(width - 1)),
        }
        out = z.select("zone", *[cols[k].alias(k) for k in cols], outside.alias("off_tile"))
        return out.filter((F.col("row_min") <= F.col("row_max")) & (F.col("col_min") <= F.col("col_max")))
    raise ValueError("off_tile must be 'clamp' or 'drop'")


def in_box(row_min, row_max, col_min, col_max, row: str = "row", col: str = "col") -> Column:
    """All four bounds inclusive."""
    return F.col(row).between(row_min, row_max) & F.col(col).between(col_min, col_max)


def bbox_filter(obs: DataFrame, row_min: int, row_max: int, col_min: int, col_max: int) -> DataFrame:
    """Literal box: becomes a Parquet pushed filter on ``row``/``col`` (and on the Morton key, if ``obs`` has one)."""
    obs = _near(obs, [(row_min, row_max, col_min, col_max)])
    return obs.filter(in_box(F.lit(row_min), F.lit(row_max), F.lit(col_min), F.lit(col_max)))


EDGES = ("row_min", "row_max", "col_min", "col_max")


def _near(obs: DataFrame, boxes: list[tuple[int, int, int, int]]) -> DataFrame:
    """``obs`` without pixels far from all boxes, where a Morton key can tell: key ranges reach the Parquet scan."""
    if morton.KEY not in obs.columns:
        return obs
    return obs.filter(morton.in_ranges(morton.key_ranges(boxes)))


def _tile_key(boxes: DataFrame) -> list[str]:
    return ["tile_id"] if "tile_id" in boxes.columns else []


def _collect_boxes(boxes: DataFrame, limit: int) -> list:
    """Collect a zone dimension after checking it is small (bounded driver use)."""
    rows = boxes.select("zone", *_tile_key(boxes), *EDGES).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} zones; use strategy='cells'")
    return rows


def _literal_box(r) -> Column:
    box = in_box(F.lit(r.row_min), F.lit(r.row_max), F.lit(r.col_min), F.lit(r.col_max))
    return box & (F.col("tile_id") == r.tile_id) if "tile_id" in r else box


def _tag_array(rows) -> Column:
    """``array(CASE WHEN in box THEN zone END, ...)``: exploded as is and
    NULL tags dropped afterwards -- no lambda, so the generator stays inside
    whole-stage code generation."""
    tags = [F.when(_literal_box(r), F.lit(r.zone)) for r in rows]
    return F.array(*tags)


def _envelope(rows) -> Column:
    return in_box(
        F.lit(min(r.row_min for r in rows)),
        F.lit(max(r.row_max for r in rows)),
        F.lit(min(r.col_min for r in rows)),
        F.lit(max(r.col_max for r in rows)),
    )


def assign_zones(
    obs: DataFrame,
    boxes: DataFrame,
    strategy: str = "auto",
    cell: int | None = None,
    max_inline: int = MAX_INLINE_ZONES,
    max_broadcast_cells: int = MAX_BROADCAST_CELLS,
) -> DataFrame:
    """``obs`` rows tagged with every zone whose box contains them (``zone`` column).

    ``auto`` picks ``inline`` for at most ``max_inline`` zones (counted
    first) and ``cells`` beyond.  ``cell`` is the side of a cell in pixels,
    by default that of a typical box, so that a box lies in few cells and a
    cell holds few pixels.
    """
    if strategy == "auto":
        n_zones = boxes.limit(max_inline + 1).count()
        strategy = "inline" if n_zones <= max_inline else "cells"
    if strategy == "inline":
        rows = _collect_boxes(boxes, max_inline)
        if not rows:
            return obs.limit(0).withColumn("zone", F.lit(None).cast("string"))
        near = _near(obs, [tuple(r[e] for e in EDGES) for r in rows])
        pre = near.filter(reduce(lambda a, b: a | b, [_literal_box(r) for r in rows]) & _envelope(rows))
        return pre.withColumn("zone", F.explode(_tag_array(rows))).filter(F.col("zone").isNotNull())
    if strategy == "cells":
        tile = _tile_key(boxes)
        b = boxes.select("zone", *tile, *EDGES)
        cell = cell or _cell_side(b)
        cells = b.select(
            "*",
            F.explode(F.sequence(F.floor(F.col("row_min") / cell), F.floor(F.col("row_max") / cell))).alias("_cr"),
        ).select(
            "*",
            F.explode(F.sequence(F.floor(F.col("col_min") / cell), F.floor(F.col("col_max") / cell))).alias("_cc"),
        )
        # one small action: the cell count (broadcast size check) and the
        # envelope of all boxes (a literal filter the Parquet scan can use)
        env = cells.agg(
            F.count(F.lit(1)).alias("n"),
            F.min("row_min").alias("a"), F.max("row_max").alias("b"),
            F.min("col_min").alias("c"), F.max("col_max").alias("d"),
        ).first()
        if env.n <= max_broadcast_cells:
            cells = F.broadcast(cells)
        o = obs.withColumn("_cr", F.floor(F.col("row") / cell)).withColumn("_cc", F.floor(F.col("col") / cell))
        if env.a is not None:
            o = _near(o, [(env.a, env.b, env.c, env.d)])
            o = o.filter(in_box(F.lit(env.a), F.lit(env.b), F.lit(env.c), F.lit(env.d)))
        j = o.join(
            cells,
            reduce(lambda x, y: x & y, [o[k] == cells[k] for k in (*tile, "_cr")])
            & (o["_cc"] == cells["_cc"])
            & o["row"].between(cells["row_min"], cells["row_max"])
            & o["col"].between(cells["col_min"], cells["col_max"]),
        )
        return j.select(*[o[c] for c in obs.columns], cells["zone"])
    raise ValueError(f"unknown strategy {strategy!r}")


def _cell_side(boxes: DataFrame) -> int:
    """A side for which the boxes lie in a few cells each, all together: their mean side or root mean area."""
    h, w = F.col("row_max") - F.col("row_min") + 1, F.col("col_max") - F.col("col_min") + 1
    r = boxes.agg(F.avg(F.greatest(h, w)).alias("side"), F.avg(h.cast("double") * w).alias("area")).first()
    return max(1, math.ceil(max(r.side or 1.0, (r.area or 1.0) ** 0.5)))


def zone_stats(
    obs: DataFrame, boxes: DataFrame, strategy: str = "auto", method: str = "auto", by: list[str] | None = None, **kw
) -> DataFrame:
    """Five measures per (zone, date), ordered; zones with no pixel give no row.
    The numbers are exact; zones that hold few pixels a date (counted) are
    summarised in one pass, larger ones by the distributed path.
    More than ``max_inline`` zones go by ``blocks``, but those whose blocks hold
    too many pixels; these, and all if a ``method`` is named, go by ``cells``.
    ``by=["tile_id"]`` gives them per (tile_id, zone, date)."""
    keys = [*(by or []), "zone", "date"]
    key = [morton.KEY] if morton.KEY in obs.columns else []
    obs = obs.select(*dict.fromkeys([*(by or []), *_tile_key(boxes)]), "date", "row", "col", "ndvi", *key)
    if strategy == "union":
        # one filtered scan per zone (literal box -> pushed into the scan),
        # unioned, then a single grouped aggregation
        rows = _collect_boxes(boxes, kw.pop("max_inline", MAX_INLINE_ZONES))
        if not rows:
            return five_measures(obs.limit(0).withColumn("zone", F.lit(None).cast("string")), keys, method=method)
        frames = [_near(obs, [tuple(r[e] for e in EDGES)]).filter(_literal_box(r)).withColumn("zone", F.lit(r.zone).cast("string")) for r in rows]
        tagged = reduce(lambda a, b: a.unionByName(b), frames)
        return five_measures(tagged, keys, method=method).orderBy(*keys)
    if strategy == "auto" and method == "auto" and "cell" not in kw:
        limit = kw.get("max_inline", MAX_INLINE_ZONES)
        strategy = "blocks" if boxes.limit(limit + 1).count() > limit else "inline"
    if strategy == "blocks":
        return _block_stats(obs, boxes, keys, by or [], method)
    tagged = assign_zones(obs, boxes, strategy, **kw)
    return five_measures(tagged, keys, method=method).orderBy(*keys)


def _block_stats(obs: DataFrame, boxes: DataFrame, keys: list[str], by: list[str], method: str) -> DataFrame:
    env = boxes.agg(F.min("row_min").alias("a"), F.max("row_max").alias("b"), F.min("col_min").alias("c"), F.max("col_max").alias("d")).first()
    if env.a is not None:
        obs = _near(obs, [tuple(env)]).filter(in_box(*[F.lit(x) for x in env]))
    zones, series, left = block_measures(obs, boxes, by, _tile_key(boxes))
    out = zones.join(series, "figure")
    if left is None:
        # zones are put in order as one row each, and their dates are in order
        out = out.orderBy(*keys[:-1])
    out = out.select(*keys[:-1], F.inline(F.arrays_zip(*LISTS)))
    out = out.select(*keys, *[F.col(x).alias(f"ndvi_{x}") for x in ("mean", "std", "p25", "p75")], F.col("n").cast("long").alias("pixel_count"))
    if left is not None:
        out = out.unionByName(five_measures(assign_zones(obs, left, "cells"), keys, method=method)).orderBy(*keys)
    return out


def date_and_zone_stats(
    obs: DataFrame, boxes: DataFrame, method: str = "auto", max_inline: int = MAX_INLINE_ZONES
) -> tuple[DataFrame, DataFrame]:
    """Per-date and per-(zone, date) statistics of the same observations.

    Each table has scans of its own, with its own columns and filters, and the
    path that its groups' sizes ask for: one scan for both was slower, since
    it carried every pixel through the zones' keys.
    """
    return date_stats(obs, method=method), zone_stats(obs, boxes, method=method, max_inline=max_inline)


def zone_pivot(
    stats: DataFrame, measure: str = "ndvi_mean", digits: int | None = 3, names: list[str] | None = None
) -> DataFrame:
    """date x zone table of one measure; zone columns sorted, missing = NULL;
    a duplicate (date, zone) is an error.  ``names`` spares Spark the search
    for the zones (and its limit on their number)."""
    v = F.round(F.col(measure), digits) if digits is not None else F.col(measure)
    one = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate (date, zone) in pivot input"))
    ).otherwise(F.max(v))
    return stats.groupBy("date").pivot("zone", names).agg(one).orderBy("date")


def zone_error_bars(stats: DataFrame) -> DataFrame:
    """Asymmetric error bars and the p25-p75 envelope around the mean."""
    return stats.select(
        "zone",
        "date",
        "ndvi_mean",
        (F.col("ndvi_p75") - F.col("ndvi_mean")).alias("err_plus"),
        (F.col("ndvi_mean") - F.col("ndvi_p25")).alias("err_minus"),
        F.col("ndvi_p25").alias("band_lo"),
        F.col("ndvi_p75").alias("band_hi"),
    )


def zone_series(stats: DataFrame) -> DataFrame:
    """Per-zone series in date order with a 0-based position (chart input)."""
    from pyspark.sql import Window

    w = Window.partitionBy("zone").orderBy("date")
    return zone_error_bars(stats).withColumn("pos", (F.row_number().over(w) - 1).cast("int"))
