"""Mean, standard deviation and count of any number of boxes from two-dimensional prefix sums.

The pixels of a (tile, date) are laid out once as prefix sums of count, value
and square; then a box needs four look-ups, however large it is and however
many boxes there are.  The sums are built by a scan in two passes over square
blocks of cells: inside each block, and, over the blocks' edges only, across
blocks.  Boxes are cut to the cells, so that boxes of the same cells, and
corners of the same cell, are looked up once.  No date or tile is gathered; a block is the largest group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.session import checkpoint_dir

BLOCK = 64  # cells of a block's side
MAX_BROADCAST_CORNERS = 200_000  # ~50 bytes a corner
MAX_BROADCAST_SUMS = 1_000_000  # ~60 bytes a corner or box and date
SUMS = ("n", "s", "q")


def _written(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/moments-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _block_sums(batches: Iterator[pa.RecordBatch], n_keys: int, side: int) -> Iterator[pa.RecordBatch]:
    """Prefix sums inside each block from its (place, n, s, q) cells, as arrays of side * side numbers."""
    kind = pa.list_(pa.float64())
    for batch in batches:
        for i in range(batch.num_rows):
            cells = batch.column(n_keys)[i].values
            place = cells.field(0).to_numpy()
            sums = []
            for k in range(1, 4):
                plane = np.zeros(side * side)
                plane[place] = cells.field(k).to_numpy(zero_copy_only=False)
                sums.append(plane.reshape(side, side).cumsum(axis=0).cumsum(axis=1).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(i, 1) for c in range(n_keys)] + [pa.array([x], kind) for x in sums],
                names=[*batch.schema.names[:n_keys], *SUMS])


class PrefixSums:
    """Prefix sums of ``value`` by date (and tile, if ``obs`` has ``tile_id`` and ``by_tile``).

    ``step`` is the distance of neighbouring pixels; every row and column
    number must be a multiple of it and not negative (else an error).
    NULL and NaN values do not count; several observations of a cell add up.
    """

    def __init__(self, obs: DataFrame, step: int = 10, value: str = "ndvi", by_tile: bool = False, block: int = BLOCK):
        self.step, self.block = step, block
        self.keys = (["tile_id"] if by_tile else []) + ["date"]
        v = F.col(value).cast("double")
        off = (F.col("row") % step != 0) | (F.col("col") % step != 0) | (F.col("row") < 0) | (F.col("col") < 0)
        cell = lambda c: F.when(off, F.raise_error(F.lit("pixels off the grid")).cast("int")).otherwise(
            F.floor(F.col(c) / step).cast("int"))
        pixels = obs.where(v.isNotNull() & ~F.isnan(v)).select(*self.keys, cell("row").alias("r"), cell("col").alias("c"), v.alias("v"))
        cells = pixels.groupBy(*self.keys, "r", "c").agg(F.count("v").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
        place = ((F.col("r") % block) * block + F.col("c") % block).cast("int").alias("place")
        at = [F.floor(F.col(x) / block).cast("int").alias(y) for x, y in (("r", "br"), ("c", "bc"))]
        gathered = cells.groupBy(*self.keys, *at).agg(
            F.collect_list(F.struct(place, F.col("n").cast("double").alias("n"), "s", "q")).alias("cells"))
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in gathered.schema.fields[:-1])
        self.inside = _written(gathered.mapInArrow(
            partial(_block_sums, n_keys=len(self.keys) + 2, side=block), ddl + "".join(f", {x} array<double>" for x in SUMS)))
        self._scan_blocks()

    def _scan_blocks(self) -> None:
        """What lies left of each block's rows, above its columns, and left above of it: sums over the blocks' edges."""
        b, keys = self.block, self.keys
        edge = lambda x, first, step: F.transform(
            F.sequence(F.lit(0), F.lit(b - 1)), lambda i: F.element_at(F.col(x), (first + i * step + 1).cast("int")))
        sides = self.inside.select(
            *keys, "br", "bc", *[edge(x, b - 1, b).alias(f"right_{x}") for x in SUMS],
            *[edge(x, b * (b - 1), 1).alias(f"bottom_{x}") for x in SUMS])
        tile = keys[:-1]
        self.extent = _written(self.inside.groupBy(*tile).agg(F.max("br").alias("rows"), F.max("bc").alias("cols")))
        # blocks without pixels also have sums beside them; a tile's dates share its extent
        dates = self.inside.select(*keys).distinct()
        lattice = self._with_extent(dates).select(*keys, F.explode(F.sequence(F.lit(0), F.col("rows"))).alias("br"), "cols").select(
            *keys, "br", F.explode(F.sequence(F.lit(0), F.col("cols"))).alias("bc"))
        sides = lattice.join(sides, [*keys, "br", "bc"], "left")
        zeros = F.array_repeat(F.lit(0.0), b)
        rows = sides.select(*keys, "br", "bc", F.posexplode(F.arrays_zip(
            *[F.coalesce(F.col(f"{e}_{x}"), zeros).alias(f"{e}_{x}") for e in ("right", "bottom") for x in SUMS])).alias("i", "e"))
        before = lambda *by: Window.partitionBy(*keys, *by, "i").rowsBetween(Window.unboundedPreceding, -1)
        none = lambda c: F.coalesce(c, F.lit(0.0))
        rows = rows.select(*keys, "br", "bc", "i", *[none(F.sum(f"e.right_{x}").over(before("br").orderBy("bc"))).alias(f"left_{x}") for x in SUMS],
                           *[F.col(f"e.bottom_{x}").alias(f"bottom_{x}") for x in SUMS])
        rows = rows.select(*keys, "br", "bc", "i", *[f"left_{x}" for x in SUMS],
                           *[none(F.sum(f"bottom_{x}").over(before("bc").orderBy("br"))).alias(f"above_{x}") for x in SUMS])
        # the last row of what lies left of the blocks above is what lies left above
        last = F.col("i") == b - 1
        corner = Window.partitionBy(*keys, "bc", "i").orderBy("br").rowsBetween(Window.unboundedPreceding, -1)
        rows = rows.select("*", *[F.when(last, none(F.sum(f"left_{x}").over(corner))).alias(f"corner_{x}") for x in SUMS])
        self.outside = _written(rows.groupBy(*keys, "br", "bc").agg(*[
            F.sort_array(F.collect_list(F.struct("i", f"{k}_{x}"))).getField(f"{k}_{x}").alias(f"{k}_{x}")
            for k in ("left", "above") for x in SUMS], *[F.max(f"corner_{x}").alias(f"corner_{x}") for x in SUMS]))

    def _with_extent(self, df: DataFrame) -> DataFrame:
        """``df`` with the last block ``rows, cols`` of its tile, or of all."""
        tile = self.keys[:-1]
        if tile:
            return df.join(self.extent, tile)
        e = self.extent.first()
        return df.withColumn("rows", F.lit(e.rows).cast("int")).withColumn("cols", F.lit(e.cols).cast("int"))

    def cut(self, df: DataFrame, names: list[str]) -> DataFrame:
        """``df`` with its rows ``r..`` and columns ``c..`` of cells cut to the last ones of the tile, and to -1 before the first."""
        last = {"r": "rows", "c": "cols"}
        held = self._with_extent(df)
        return held.select(*[F.greatest(F.least(F.col(x).cast("long"), (F.col(last[x[0]]).cast("long") + 1) * self.block - 1), F.lit(-1)).alias(x)
                             if x in names else F.col(x) for x in df.columns])

    def at(self, corners: DataFrame) -> DataFrame:
        """``corners`` (..., r, c[, tile_id]) with every date and, as ``n, s, q``, the sums over the cells up to (r, c), both included.

        A corner before the first row or column has no sums and no row; one
        beyond the last counts as the last.
        """
        b, tile = self.block, self.keys[:-1]
        inside = self.cut(corners.where((F.col("r") >= 0) & (F.col("c") >= 0)), ["r", "c"])
        inside = inside.withColumn("br", F.floor(F.col("r") / b).cast("int")).withColumn("bc", F.floor(F.col("c") / b).cast("int"))
        i, j = (F.col("r") % b).cast("int"), (F.col("c") % b).cast("int")
        found = inside.join(self.outside, [*tile, "br", "bc"])
        sums = [(F.element_at(f"left_{x}", i + 1) + F.element_at(f"above_{x}", j + 1) + F.col(f"corner_{x}")).alias(f"out_{x}") for x in SUMS]
        found = found.select(*inside.columns, "date", *sums)
        met = found.join(self.inside, [*self.keys, "br", "bc"], "left")
        local = [(F.col(f"out_{x}") + F.coalesce(F.element_at(self.inside[x], i * b + j + 1), F.lit(0.0))).alias(x) for x in SUMS]
        return met.select(*[found[c] for c in found.columns if c not in ("br", "bc") and not c.startswith("out_")], *local)


def zone_moments(obs: DataFrame | PrefixSums, boxes: DataFrame, step: int = 10, by_tile: bool = False) -> DataFrame:
    """``zone, date, ndvi_mean, ndvi_std, pixel_count`` (led by ``tile_id`` with ``by_tile``), in order.

    The measures of ``zone_stats`` but the quartiles, from four look-ups a box
    and date; boxes without pixels on a date give no row.  Hand over a
    :class:`PrefixSums` to ask several sets of boxes.  The standard deviation
    comes from sums of squares: it loses digits only where it is a millionth
    of the mean and less.
    """
    sums = obs if isinstance(obs, PrefixSums) else PrefixSums(obs, step, by_tile=by_tile)
    step, keys = sums.step, sums.keys
    tile = [k for k in keys if k != "date"]
    edges = ["r1", "r0", "c1", "c0"]
    cell = lambda c: F.floor(c / step).cast("long")
    asked = boxes.where((F.col("row_min") <= F.col("row_max")) & (F.col("col_min") <= F.col("col_max")))
    asked = asked.select(*tile, "zone", cell(F.col("row_max")).alias("r1"), cell(F.col("row_min") - 1).alias("r0"),
                         cell(F.col("col_max")).alias("c1"), cell(F.col("col_min") - 1).alias("c0"))
    times = F.count(F.lit(1)).over(Window.partitionBy(*tile, "zone")).alias("times")
    asked = _written(sums.cut(asked.where((F.col("r1") >= 0) & (F.col("c1") >= 0)), edges).select(*tile, "zone", *edges, times))
    series = _box_series(sums, asked.select(*tile, *edges).distinct(), tile)
    met = asked.join(_broadcast(series), [*tile, *edges])
    once = met.where("times = 1").select(*tile, "zone", "v")
    # the boxes of one name are one zone
    more = met.where("times > 1").select(*tile, "zone", F.inline("v")).groupBy(*tile, "zone", "date").agg(*[F.sum(x).alias(x) for x in SUMS])
    more = more.groupBy(*tile, "zone").agg(F.sort_array(F.collect_list(F.struct("date", *SUMS))).alias("v"))
    found = once.unionByName(more).withColumn("v", F.filter("v", lambda x: x["n"] > 0.5)).where(F.size("v") > 0)
    # zones are put in order as one row each, and their dates are in order
    found = found.orderBy(*tile, "zone").select(*tile, "zone", F.inline("v"))
    mean = F.col("s") / F.col("n")
    spread = F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0))
    std = F.when(F.col("n") > 1.5, F.sqrt(spread / (F.col("n") - 1)))
    return found.select(*tile, "zone", "date", mean.alias("ndvi_mean"), std.alias("ndvi_std"),
                        F.round("n").cast("long").alias("pixel_count"))


def _broadcast(series: DataFrame) -> DataFrame:
    """Rows with an array ``v`` of sums, marked for broadcasting if these are few."""
    return F.broadcast(series) if (series.agg(F.sum(F.size("v") + 1)).first()[0] or 0) <= MAX_BROADCAST_SUMS else series


def _box_series(sums: PrefixSums, boxes: DataFrame, tile: list[str]) -> DataFrame:
    """``(tile, r1, r0, c1, c0, v)``: the sums ``date, n, s, q`` of each box of cells, an entry for each date of its tile.

    A corner is looked up once, however many boxes have it, and its dates are
    one row.  All corners of a tile have the same dates, in order.
    """
    boxes = _written(boxes)
    corners = F.explode(F.array(*[F.struct(F.col(r).alias("r"), F.col(c).alias("c")) for r in ("r1", "r0") for c in ("c1", "c0")]))
    points = _written(boxes.select(*tile, corners.alias("p")).select(*tile, "p.*").where((F.col("r") >= 0) & (F.col("c") >= 0)).distinct())
    if points.limit(MAX_BROADCAST_CORNERS + 1).count() <= MAX_BROADCAST_CORNERS:
        points = F.broadcast(points)
    at = _written(sums.at(points).groupBy(*tile, "r", "c").agg(F.sort_array(F.collect_list(F.struct("date", *SUMS))).alias("v")))
    at = _broadcast(at)
    met = boxes
    for r in ("r1", "r0"):
        for c in ("c1", "c0"):
            corner = at.select(*tile, F.col("r").alias(r), F.col("c").alias(c), F.col("v").alias(r + c))
            met = met.join(corner, [*tile, r, c], "inner" if r + c == "r1c1" else "left")

    def of_date(x, i):
        part = lambda name, k: F.coalesce(F.get(F.col(name), i)[k], F.lit(0.0))
        return F.struct(x["date"].alias("date"), *[
            (x[k] - part("r0c1", k) - part("r1c0", k) + part("r0c0", k)).alias(k) for k in SUMS])

    return _written(met.select(*tile, "r1", "r0", "c1", "c0", F.transform("r1c1", of_date).alias("v")))
