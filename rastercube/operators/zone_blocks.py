"""Five measures of many zones: each block of pixels is laid out once for all the zones in it.

A join would make a row for every pixel of every zone, which grows with both.
Here boxes are first cut to the rows and columns that have pixels, and zones
with the same boxes share one figure, which is measured once.  Figures with
boxes of about one size (up to a power of two) share a grid of blocks four
times as wide, and a box belongs to the block of its first corner.  The pixels
of a (block, date), with those beside it that its boxes reach, meet the figures
in one task, which reads their pixels from rows sorted by place.

The boxes of a figure may lie in several blocks (of several tiles): such
figures meet the pixels of all their blocks, as far as any of them reaches,
together.  Where few figures share far-flung blocks, so that this would move
more pixels than the figures have, their boxes' values are brought together
instead.

A (set of blocks, date) is the largest group.  Figures whose groups hold more
than ``MAX_PIXELS`` (counted first) are left to the caller, and zones of more
than ``MAX_PARTS`` boxes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastercube.session import checkpoint_dir

SIDES = 4  # a block's side, in sides of its boxes
MAX_PIXELS = 1_000_000  # ~30 bytes each
MAX_PARTS = 64
CHUNK_BOXES = 20_000  # boxes that meet a block's pixels at once
MAX_BROADCAST_BOXES = 500_000  # ~60 bytes each
MAX_BROADCAST_BLOCKS = 200_000
WORTH = 2  # a pixel that is moved costs as much as so many values
GATHERED = 2_000_000  # pixels of boxes that a task lays side by side
EDGES = ("row_min", "row_max", "col_min", "col_max")
MEASURES = ("mean", "std", "p25", "p75")
LISTS = ("date", *MEASURES, "n")
_MEASURED = "mean double, std double, p25 double, p75 double, n long"


def _written(df: DataFrame) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession)}/zones-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured(values: np.ndarray, counts: np.ndarray) -> dict[str, pa.Array]:
    """The measures of consecutive runs of ``counts`` (positive) ascending values; NaN, which come last, are missing."""
    first = np.cumsum(counts) - counts
    there = ~np.isnan(values)
    n = np.add.reduceat(there.astype(np.int64), first)
    some, known = n > 0, np.where(there, values, 0.0)
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        mean = np.add.reduceat(known, first) / n
        off = np.where(there, values - np.repeat(mean, counts), 0.0)
        std = np.sqrt(np.add.reduceat(off * off, first) / (n - 1))
        out = {"mean": pa.array(mean, mask=~some), "std": pa.array(std, mask=n < 2)}
        for name, p in (("p25", 0.25), ("p75", 0.75)):
            at = np.maximum(n - 1, 0) * p
            lo, hi = np.floor(at), np.ceil(at)
            a, b = values[first + lo.astype(np.int64)], values[first + hi.astype(np.int64)]
            out[name] = pa.array(np.where(a == b, a, (hi - at) * a + (at - lo) * b), mask=~some)
    out["n"] = pa.array(n)
    return out


class _Block:
    """The pixels of a set of blocks and a date, sorted by place, and the numbers of their values' order."""

    def __init__(self, home: np.ndarray, row: np.ndarray, col: np.ndarray, value: np.ndarray):
        self.rows, r = np.unique(_line(home, row), return_inverse=True)
        self.cols, c = np.unique(col, return_inverse=True)
        key = r.astype(np.int64) * len(self.cols) + c
        order = np.argsort(key, kind="stable")
        self.key = key[order]
        by_value = np.argsort(value, kind="stable")
        self.values = value[by_value]
        rank = np.empty(len(value), np.int64)
        rank[by_value] = np.arange(len(value))
        self.rank = rank[order]

    def cut(self, home: np.ndarray, edges: list[np.ndarray], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The boxes that hold rows and columns of the block, as (a, b, c, d), half open, and whose they are."""
        a, b = np.searchsorted(self.rows, _line(home, edges[0])), np.searchsorted(self.rows, _line(home, edges[1]), "right")
        c, d = np.searchsorted(self.cols, edges[2]), np.searchsorted(self.cols, edges[3], "right")
        hit = np.flatnonzero((a < b) & (c < d))
        return np.stack([a[hit], b[hit], c[hit], d[hit]], axis=1), owner[hit]

    def different(self, boxes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners of equal single boxes as one: boxes and owners of the different ones, all owners, and each one's number there."""
        every, first, n = np.unique(owner, return_index=True, return_counts=True)
        one = boxes[first]
        _, tall = np.unique(one[:, 0] * (len(self.rows) + 1) + one[:, 1], return_inverse=True)
        _, wide = np.unique(one[:, 2] * (len(self.cols) + 1) + one[:, 3], return_inverse=True)
        mark = np.where(n == 1, tall * (len(every) + 1) + wide, -1 - np.arange(len(every)))
        _, chosen, number = np.unique(mark, return_index=True, return_inverse=True)
        place = np.full(len(every), -1)
        place[chosen] = np.arange(len(chosen))
        of = place[np.repeat(np.arange(len(every)), n)]
        keep = np.flatnonzero(of >= 0)
        keep = keep[np.argsort(of[keep], kind="stable")]
        return boxes[keep], of[keep], every, number

    def gathered(self, boxes: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(owners' numbers, ascending values of one after another, how many each has), for those with pixels; owners ascend."""
        a, b, c, d = boxes.T
        rows = b - a
        box = np.repeat(np.arange(len(boxes)), rows)
        line = (np.arange(len(box)) - np.repeat(np.cumsum(rows) - rows, rows) + a[box]) * len(self.cols)
        start = np.searchsorted(self.key, line + c[box])
        size = np.searchsorted(self.key, line + d[box]) - start
        n_owners = int(owner[-1]) + 1 if len(owner) else 0
        whose = owner[box]
        count = np.bincount(whose, size, n_owners).astype(np.int64)
        upto = np.cumsum(count)
        lines = np.searchsorted(whose, np.arange(n_owners + 1))
        at = 0
        while at < n_owners:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + GATHERED, "right")))
            s, n = start[lines[at]:lines[end]], size[lines[at]:lines[end]]
            place = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found = np.flatnonzero(count[at:end])
            if len(found):
                both = (np.repeat(np.arange(end - at), count[at:end]) << 32) | self.rank[place]
                both.sort()
                yield at + found, self.values[both & 0xFFFFFFFF], count[at:end][found]
            at = end


def _line(home: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Numbers in order of block and row."""
    return (home.astype(np.int64) << 34) + row


def _measure_blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, n_keys: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """For each (keys, pixels, figures): the figures' measures if they are whole, else the values of each."""
    for batch in batches:
        for i in range(batch.num_rows):
            pixels, figures = batch.column("pixels")[i].values, batch.column("figures")[i].values
            home, row, col, value = (pixels.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            block = _Block(home, row, col, value.astype(np.float64))
            boxes = figures.field(1)
            owner = np.repeat(np.arange(len(figures)), boxes.value_lengths().to_numpy(zero_copy_only=False))
            home, *edges = (boxes.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(5))
            cut, owner = block.cut(home, edges, owner)
            keys = lambda m: [batch.column(k).take(pa.array(np.full(m, i))) for k in range(n_keys)]
            figure = figures.field(0)
            if not whole:
                for found, values, counts in block.gathered(cut, owner):
                    ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                    lists = pa.ListArray.from_arrays(ends, pa.array(values)).cast(schema.field("values").type)
                    yield pa.RecordBatch.from_arrays([figure.take(pa.array(found)), *keys(len(found)), lists], schema=schema)
                continue
            boxes, of, every, number = block.different(cut, owner)
            tables, place, n = [], np.full(len(every), -1), 0
            for found, values, counts in block.gathered(boxes, of):
                tables.append(measured(values, counts))
                place[found] = n + np.arange(len(found))
                n += len(found)
            some = np.flatnonzero(place[number] >= 0) if len(every) else []
            if len(some):
                take = pa.array(place[number[some]])
                yield pa.RecordBatch.from_arrays(
                    [figure.take(pa.array(every[some])), *keys(len(some)),
                     *[pa.concat_arrays([m[name] for m in tables]).take(take) for name in (*MEASURES, "n")]], schema=schema)


def _ordered(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values, ascending in each group, NaN last; groups are small numbers in ascending order."""
    if values.dtype != np.float32:
        return values[np.lexsort((values, group))].astype(np.float64)
    # a float's bits as a number that sorts like it, below its group's
    bits = np.where(np.isnan(values), np.float32("nan"), values).view(np.uint32)
    both = (group.astype(np.uint64) << 32) | np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31))
    both.sort()
    bits = both.astype(np.uint32)
    return np.where(bits >> 31, bits & np.uint32((1 << 31) - 1), ~bits).view(np.float32).astype(np.float64)


def _measure_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The measures of each row's lists of values, all together; many rows at once."""
    for batch in batches:
        every = batch.column("all")
        lists = every.flatten()
        values = lists.flatten().to_numpy(zero_copy_only=False)
        inner = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        upto = inner[np.concatenate(([0], np.cumsum(every.value_lengths().to_numpy(zero_copy_only=False))))]
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + GATHERED, "right")) - 1)
            counts = np.diff(upto[at: end + 1])
            m = measured(_ordered(np.repeat(np.arange(end - at), counts), values[upto[at]: upto[end]]), counts)
            yield pa.RecordBatch.from_arrays([batch.column("parts").slice(at, end - at), *[m[x] for x in (*MEASURES, "n")]],
                                             names=["parts", *MEASURES, "n"])
            at = end


def _cut(pixels: DataFrame, boxes: DataFrame, tile: list[str]) -> DataFrame:
    """Boxes from the first to the last row and column in them that have pixels in the tile; the others have none."""
    axes = F.explode(F.array(*[F.struct(F.lit(x).alias("axis"), F.col(x).cast("long").alias("x")) for x in ("row", "col")]))
    there = pixels.select(*tile, axes.alias("p")).select(*tile, "p.*").distinct().withColumn("at", F.col("x"))
    asked = F.explode(F.array(*[F.struct(F.lit(e[:3]).alias("axis"), F.col(e).cast("long").alias("x")) for e in EDGES]))
    asked = boxes.select(*tile, asked.alias("p")).select(*tile, "p.*").distinct().withColumn("at", F.lit(None).cast("long"))
    places = there.unionByName(asked).where("x is not null").groupBy(*tile, "axis", "x").agg(F.max("at").alias("at"))
    order = Window.partitionBy(*tile, "axis").rowsBetween(Window.unboundedPreceding, 0)
    near = _written(places.select(
        *tile, "axis", "x", F.last("at", ignorenulls=True).over(order.orderBy("x")).alias("max"),
        F.last("at", ignorenulls=True).over(order.orderBy(F.desc("x"))).alias("min")))
    near = _few(near)
    for e in EDGES:
        axis, side = e.split("_")
        boxes = boxes.withColumn(e, F.col(e).cast("long")).join(
            near.where(F.col("axis") == axis).select(*tile, F.col("x").alias(e), F.col(side).alias("_at")), [*tile, e])
        boxes = boxes.drop(e).withColumnRenamed("_at", e)
    return boxes.where((F.col("row_min") <= F.col("row_max")) & (F.col("col_min") <= F.col("col_max")))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MAX_BROADCAST_BLOCKS + 1).count() <= MAX_BROADCAST_BLOCKS else df


def _numbered(df: DataFrame, name: str) -> DataFrame:
    return _written(df.distinct().select("*", F.monotonically_increasing_id().alias(name)))


def _level(boxes: str) -> Column:
    """The power of two that the sides of all boxes are up to."""
    side = lambda b: F.greatest(b["row_max"] - b["row_min"], b["col_max"] - b["col_min"]) + 1
    return F.array_max(F.transform(boxes, lambda b: F.ceil(F.log2(side(b).cast("double"))).cast("int")))


def _placed(figures: DataFrame, tile: list[str]) -> DataFrame:
    """Figures with their boxes' ``level``, the blocks ``homes`` of these in it and the number ``home`` of each box's."""
    width = F.lit(SIDES) * F.pow(F.lit(2.0), F.col("level"))
    home = lambda b: F.struct(*[b[k].alias(k) for k in tile], *[F.floor(b[f"{x}_min"] / width).alias(f"b{x[0]}") for x in ("row", "col")])
    at = figures.withColumn("level", _level("boxes"))
    at = at.withColumn("homes", F.array_sort(F.array_distinct(F.transform("boxes", home))))
    boxes = F.transform("boxes", lambda b: F.struct(
        F.array_position(F.col("homes"), home(b)).cast("int").alias("home"), *[b[e].alias(e) for e in EDGES]))
    return at.select("figure", "level", "homes", boxes.alias("places"), "boxes")


def _reach(places: DataFrame, keys: list[str]) -> DataFrame:
    """How far the boxes of each (keys, home) reach, and their area."""
    area = lambda: ((F.col("row_max") - F.col("row_min") + 1) * (F.col("col_max") - F.col("col_min") + 1)).cast("double")
    reach = places.select(*keys, F.inline("places")).groupBy(*keys, "home").agg(
        *[(F.min if e.endswith("min") else F.max)(e).alias(e) for e in EDGES], F.sum(area()).alias("area"))
    return reach.withColumn("reached", area())


def _met(figures: DataFrame, tile: list[str]) -> DataFrame:
    """``(figure, level, homes, places, part)``: figures that are met whole, and the others' boxes one by one, as parts."""
    placed = _placed(figures, tile)
    several = placed.where(F.size("homes") > 1)
    # worth it where the blocks' pixels, as far as they are needed, are fewer than those of the figures
    worth = _reach(several, ["level", "homes"]).groupBy("level", "homes").agg(
        F.sum("area").alias("area"), F.sum("reached").alias("reached")).select(
        "level", "homes", (F.col("reached") * WORTH <= F.col("area")).alias("worth"))
    judged = _written(several.join(worth, ["level", "homes"]))
    each = judged.where("not worth").select("figure", F.explode("boxes").alias("b")).select("figure", F.array("b").alias("boxes"))
    columns = ["figure", "level", "homes", "places"]
    whole = placed.where(F.size("homes") == 1).select(*columns).unionByName(judged.where("worth").select(*columns))
    return whole.withColumn("part", F.lit(False)).unionByName(_placed(each, tile).select(*columns).withColumn("part", F.lit(True)))


def _spread(pixels: DataFrame, levels: list[int]) -> DataFrame:
    """Pixels once for each block whose boxes may hold them: their own, and the ones before if they are near its edge."""
    at = pixels.withColumn("level", F.explode(F.array(*[F.lit(x).cast("int") for x in levels])))
    side = F.pow(F.lit(2.0), F.col("level"))
    for x, name in (("row", "br"), ("col", "bc")):
        own = F.floor(F.col(x) / (side * SIDES))
        near = F.col(x) - own * side * SIDES < side - 1
        at = at.withColumn(name, F.explode(F.when(near, F.array(own, own - 1)).otherwise(F.array(own))))
    return at


def block_measures(
    obs: DataFrame, boxes: DataFrame, by: list[str], tile: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The zones' figures, the figures' measures, and the boxes of zones that are left to the caller, if any.

    Zones are (by, zone, figure), measures (figure, by) with the lists of
    ``LISTS``, an entry for each date, in order; columns of ``by`` are the
    zones' if the boxes hold them, else the measures'.  ``obs`` has ``date, row,
    col, ndvi`` and the columns of ``by`` and ``tile``; ``tile`` are those that
    the boxes hold, too.
    """
    spark = obs.sparkSession
    apart = [*[k for k in by if k not in tile], "date"]
    zone_key = [k for k in by if k in tile] + ["zone"]
    kind = obs.schema["ndvi"].dataType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    pixels = obs.select(*dict.fromkeys([*tile, *apart]), "row", "col", F.col("ndvi").cast(kind).alias("ndvi"))

    held = boxes.where((F.col("row_min") <= F.col("row_max")) & (F.col("col_min") <= F.col("col_max")))
    parts = F.count(F.lit(1)).over(Window.partitionBy(*zone_key))
    held = _written(_cut(pixels, held.select("zone", *tile, *EDGES), tile).withColumn("n_parts", parts))
    left = held.where(F.col("n_parts") > MAX_PARTS).select("zone", *tile, *EDGES)
    zones = _written(held.where(F.col("n_parts") <= MAX_PARTS).groupBy(*zone_key).agg(
        F.sort_array(F.collect_list(F.struct(*tile, *EDGES))).alias("boxes")))
    figures = _numbered(zones.select("boxes"), "figure")
    zones = _written(zones.join(figures, "boxes").select(*zone_key, "figure"))

    met = _written(_met(figures, tile))
    sets = _numbered(met.select("part", "level", "homes"), "set")
    met = _written(met.join(sets, ["part", "level", "homes"]).select("set", "part", "figure", "places"))
    levels = [tuple(r) for r in sets.select("level", "part").distinct().orderBy("level", "part").collect()]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pixels.select(*apart).schema)
    keyed = f"figure long, {fields}"
    if not levels:
        none = spark.createDataFrame([], f"{keyed}, {_MEASURED}")
        return zones, _by_figure(none, apart), left if left.limit(1).count() else None

    homes = sets.select("set", "part", "level", F.posexplode("homes").alias("home", "h")).select(
        "set", "part", "level", (F.col("home") + 1).alias("home"), "h.*")
    needs = _few(_written(homes.join(_reach(met, ["set"]).drop("area", "reached"), ["set", "home"])))
    reached = F.col("row").between(F.col("row_min"), F.col("row_max")) & F.col("col").between(F.col("col_min"), F.col("col_max"))

    def spread(*parts: bool) -> DataFrame:
        wanted = list(dict.fromkeys(x for x, part in levels if part in parts))
        return _spread(pixels, wanted).join(needs.where(F.col("part").isin(*parts)), ["level", *tile, "br", "bc"]).where(reached)

    sizes = spread(False, True).groupBy("set", *apart).count().groupBy("set").agg(F.max("count").alias("n"))
    dense = _written(sizes.where(F.col("n") > MAX_PIXELS).select("set"))
    if dense.limit(1).count():
        too_large = _written(met.join(dense, "set", "left_semi").select("figure").distinct())
        left = left.unionByName(zones.join(too_large, "figure", "left_semi").join(figures, "figure").select(
            *[k for k in zone_key if k not in tile], F.inline("boxes")).select("zone", *tile, *EDGES))
        zones = zones.join(too_large, "figure", "left_anti")
        met = met.join(too_large, "figure", "left_anti")
        needs = needs.join(dense, "set", "left_anti")

    upto = Window.partitionBy("set").orderBy("figure").rowsBetween(Window.unboundedPreceding, 0)
    chunk = F.floor((F.sum(F.size("places")).over(upto) - 1) / CHUNK_BOXES).alias("chunk")
    lists = met.select("set", "part", chunk, F.struct("figure", "places").alias("f"))
    lists = lists.groupBy("set", "part", "chunk").agg(F.collect_list("f").alias("figures")).drop("chunk")
    few = met.limit(MAX_BROADCAST_BOXES + 1).count() <= MAX_BROADCAST_BOXES

    def measure(part: bool, ddl: str) -> DataFrame:
        own = lists.where(F.col("part") == part).drop("part")
        gathered = spread(part).groupBy("set", *apart).agg(
            F.collect_list(F.struct("home", "row", "col", F.coalesce("ndvi", F.lit(float("nan"))).alias("v"))).alias("pixels"))
        joined = gathered.join(F.broadcast(own) if few else own, "set").select(*apart, "pixels", "figures")
        schema = pa.schema([*_arrow(spark, ddl)])
        return joined.mapInArrow(partial(_measure_blocks, schema=schema, n_keys=len(apart), whole=not part), ddl)

    found = None
    if any(not part for _, part in levels):
        found = measure(False, f"{keyed}, {_MEASURED}")
    if any(part for _, part in levels):
        values = measure(True, f"{keyed}, values array<{kind}>").groupBy(F.struct("figure", *apart).alias("parts"))
        several = values.agg(F.collect_list("values").alias("all")).mapInArrow(
            _measure_parts, f"parts struct<{', '.join(x.replace(' ', ':', 1) for x in keyed.split(', '))}>, {_MEASURED}")
        several = several.select("parts.*", *MEASURES, "n")
        found = found.unionByName(several) if found else several
    return zones, _by_figure(found, apart), left if left.limit(1).count() else None


def _by_figure(found: DataFrame, apart: list[str]) -> DataFrame:
    """A row for each figure: a list of dates, in order, and one of each measure, which take less room than a list of rows."""
    rows = F.sort_array(F.collect_list(F.struct("date", *MEASURES, F.col("n").cast("int").alias("n"))))
    found = found.groupBy("figure", *apart[:-1]).agg(rows.alias("v"))
    return found.select("figure", *apart[:-1], *[F.col("v")[x].alias(x) for x in LISTS])


def _arrow(spark, ddl: str) -> Iterator[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return iter(to_arrow_schema(spark.createDataFrame([], ddl).schema))
