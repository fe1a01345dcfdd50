"""Grid binning, block means and the dense ``row x col x time`` cube as tables.

The cube is never assembled on one machine.  Its long form is a DataFrame
``(t, date, row_ds, col_ds, value)`` covering every lattice cell (missing =
NULL), generated strip by strip (no cross join, and the full volume is never
shuffled).  The vector form gathers each cell's values over time into one
array (bounded by the number of dates).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastercube.functions.columns import clamp_keep_null, fill_missing, trunc_div_int

MAX_BROADCAST_DATES = 100_000


def bin_cells(obs: DataFrame, n: int, row: str = "row", col: str = "col") -> DataFrame:
    """Add ``row_ds = int(row / n)``, ``col_ds = int(col / n)`` (truncation)."""
    return obs.withColumn("row_ds", trunc_div_int(row, n)).withColumn("col_ds", trunc_div_int(col, n))


def block_means(obs: DataFrame, n: int = 10, value: str = "ndvi", by: list[str] | None = None) -> DataFrame:
    """Mean of ``value`` per (date, row_ds, col_ds).

    Pixels of different tiles on one date that share grid coordinates are
    averaged together, as the reference does; ``by=["tile_id"]`` keeps the
    tiles apart instead.
    """
    by = list(by or [])
    return (
        bin_cells(obs.select("date", *by, "row", "col", value), n)
        .groupBy("date", *by, "row_ds", "col_ds")
        .agg(F.avg(value).alias("ndvi_mean"))
    )


def cube_extent(means: DataFrame) -> DataFrame:
    """One row: ``n_rows = max(row_ds)+1``, ``n_cols = max(col_ds)+1``, ``n_dates``.

    Extents are taken over all dates together.
    """
    return means.agg(
        (F.max("row_ds") + 1).cast("int").alias("n_rows"),
        (F.max("col_ds") + 1).cast("int").alias("n_cols"),
        F.countDistinct("date").cast("int").alias("n_dates"),
    )


def time_axis(df: DataFrame) -> DataFrame:
    """Distinct dates, sorted, with their 0-based position ``t``.

    The window runs after ``distinct`` on the (small) set of dates only.
    """
    d = df.select("date").distinct()
    return d.select("date", (F.dense_rank().over(Window.orderBy("date")) - 1).cast("int").alias("t"))


def planes(df: DataFrame, by: list[str], dates: DataFrame) -> DataFrame:
    """The planes of a cube: ``date, t`` and, with ``by``, each (by, date) that has data."""
    return df.select("date", *by).distinct().join(dates, "date") if by else dates


def _checked_dates(dates: DataFrame, limit: int = MAX_BROADCAST_DATES, n: int | None = None) -> tuple[DataFrame, int]:
    """Broadcast the dates axis only when its (counted) size is below ``limit``."""
    n = dates.count() if n is None else n
    return (F.broadcast(dates) if n <= limit else dates), n


def with_time_index(means: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Attach ``t`` to each block mean (broadcast join to the dates axis)."""
    dates = dates if dates is not None else time_axis(means)
    d, _ = _checked_dates(dates)
    return means.join(d, "date")


def extent_from_obs(obs: DataFrame, n: int) -> tuple[int, int, int] | None:
    """``(n_rows, n_cols, n_dates)`` of the block-``n`` grid, read from two
    integer columns and the date of the observations (no aggregation of the
    block means).  Truncation is monotone, so ``max(int(r/n)) = int(max(r)/n)``."""
    r = obs.agg(F.max("row").alias("r"), F.max("col").alias("c"), F.countDistinct("date").alias("d")).first()
    if r is None or r.r is None:
        return None
    return int(r.r / n) + 1, int(r.c / n) + 1, int(r.d)


def _extent(means: DataFrame, extent: tuple[int, int, int] | None):
    if extent is not None:
        return extent
    ext = cube_extent(means).first()
    if ext is None or ext.n_rows is None:
        return None
    return int(ext.n_rows), int(ext.n_cols), int(ext.n_dates)


STRIP = 64  # columns of a strip
WIDE_DATES = 16  # up to so many dates a cell's series is one row of the hash aggregation


def dense_cube(
    means: DataFrame,
    partitions: int | None = None,
    extent: tuple[int, int, int] | None = None,
    by_time: bool = False,
    by: list[str] | None = None,
) -> DataFrame:
    """Every (t, row_ds, col_ds) cell of the lattice; value FLOAT, NULL = missing.

    With ``by=["tile_id"]`` every tile has planes of its own, one for each
    date that it was taken on, all on the common time axis and of the common
    (largest) extent.

    Block means are gathered per (date, row, strip of ``STRIP`` columns) into
    a ``col -> value`` map; a lattice generated from the planes supplies
    strips without any data.  The dense rows are generated by exploding each strip
    after the last shuffle, so the full ``rows x cols x dates`` volume is never
    shuffled or joined, and the work grows with the width, not its square.
    ``by_time`` rebalances the strips on ``t`` for ``store.write_cube``.
    """
    spark = means.sparkSession
    ext = _extent(means, extent)
    if ext is None:
        keyed = "".join(f"{k} {means.schema[k].dataType.simpleString()}, " for k in by or [])
        return spark.createDataFrame([], f"t int, date string, {keyed}row_ds int, col_ds int, value float")
    n_rows, n_cols = ext[0], ext[1]
    by = list(by or [])
    d, _ = _checked_dates(time_axis(means), n=ext[2])
    strips = (
        means.join(d, "date")
        .groupBy("t", *by, "row_ds", F.floor(F.col("col_ds") / STRIP).cast("int").alias("_s"))
        .agg(F.map_from_entries(F.collect_list(F.struct("col_ds", F.col("ndvi_mean").cast("float")))).alias("_m"))
    )
    # the strips of every plane, a row for STRIP cells
    lattice = planes(means, by, d).withColumn("row_ds", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
    if partitions:
        lattice = lattice.repartition(partitions, "t", *by, "row_ds")
    lattice = lattice.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit((n_cols - 1) // STRIP))))
    dense = lattice.join(strips, ["t", *by, "row_ds", "_s"], "left")
    if by_time:
        dense = dense.hint("rebalance", "t")
    first = F.col("_s") * STRIP
    cells = F.transform(
        F.sequence(first, F.least(first + STRIP, F.lit(n_cols)) - 1), lambda c: F.element_at(F.col("_m"), c)
    )
    return dense.select("t", "date", *by, "row_ds", "_s", F.posexplode(cells).alias("col_ds", "value")).select(
        "t", "date", *by, "row_ds", (F.col("col_ds") + F.col("_s") * STRIP).cast("int").alias("col_ds"), "value"
    )


def cube_slice(cube: DataFrame, t: int) -> DataFrame:
    """One time plane (partition-pruned when read from the stored cube)."""
    return cube.filter(F.col("t") == t)


def cube_series(cube: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per cell of a (stored) dense cube, the values over time as
    ``ARRAY<FLOAT>`` indexed by ``t``.  Each group holds one value per date."""
    by = list(by or [])
    n_dates = cube.agg(F.max("t")).first()[0]
    n_dates = 0 if n_dates is None else int(n_dates) + 1
    return _series(cube, [*by, "row_ds", "col_ds"], F.col("value"), n_dates)


def _series(values: DataFrame, keys: list[str], value: Column, n_dates: int) -> DataFrame:
    """``keys, series`` from one value per key and ``t``; two values are an error.

    A few dates are aggregated as one number each, in place; the pairs of many
    are gathered and sorted, since a row would be as wide as there are dates.
    """
    value = value.cast("float")
    if n_dates > WIDE_DATES:
        g = values.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("t", value.alias("value")))).alias("_v"))
        return g.select(*keys, _series_array("_v", n_dates).alias("series"))
    g = values.groupBy(*keys).agg(F.count(value).alias("_n"), *[F.max(F.when(F.col("t") == k, value)).alias(f"_{k}") for k in range(n_dates)])
    found = sum((F.col(f"_{k}").isNotNull().cast("int") for k in range(n_dates)), F.lit(0))
    none = F.lit(None).cast("array<float>")
    twice = F.when(F.col("_n") != found, F.raise_error(F.lit("two values of one cell and date")).cast("array<float>"))
    series = F.array(*[F.col(f"_{k}") for k in range(n_dates)]).cast("array<float>") if n_dates else none
    return g.select(*keys, F.coalesce(twice, series).alias("series"))


def _series_array(pairs: str, n_dates: int):
    """Sorted (t, value) pairs as an array of ``n_dates``: each pair brings the NULLs of the gap before it."""
    none = F.lit(None).cast("float")

    def upto(i):
        return F.coalesce(F.get(F.col(pairs), i)["t"], F.lit(-1))

    def with_gap(pair, i):
        gap = pair["t"] - upto(i - 1) - 1
        gap = F.when(gap < 0, F.raise_error(F.lit("two values of one cell and date")).cast("int")).otherwise(gap)
        return F.concat(F.array_repeat(none, gap), F.array(pair["value"].cast("float")))

    filled = F.flatten(F.transform(F.col(pairs), with_gap))
    return F.concat(filled, F.array_repeat(none, F.lit(n_dates - 1) - upto(F.size(pairs) - 1)))


def series_from_means(
    means: DataFrame, partitions: int | None = None, extent: tuple[int, int, int] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """Vector form of the dense cube straight from the block means.

    Cells with data gather their (t, value) pairs (at most one per date);
    a ``rows x cols`` lattice -- the number of dates times smaller than the
    dense cube -- supplies cells without any data as all-NULL series.
    ``by=["tile_id"]`` gives every tile series of its own.
    """
    spark = means.sparkSession
    ext = _extent(means, extent)
    if ext is None:
        keyed = "".join(f"{k} {means.schema[k].dataType.simpleString()}, " for k in by or [])
        return spark.createDataFrame([], f"{keyed}row_ds int, col_ds int, series array<float>")
    n_rows, n_cols = ext[0], ext[1]
    by = list(by or [])
    d, n_dates = _checked_dates(time_axis(means), n=ext[2])
    present = _series(means.join(d, "date"), [*by, "row_ds", "col_ds"], F.col("ndvi_mean"), n_dates)
    total, plane = n_rows * n_cols, n_rows * n_cols
    if by:
        groups = means.select(*by).distinct().withColumn("_g", (F.row_number().over(Window.orderBy(*by)) - 1).cast("int"))
        groups, n_groups = _checked_dates(groups)
        total *= n_groups
    # each output row carries n_dates values: aim at ~1M values per partition
    parts = partitions or max(1, min(total * max(n_dates, 1) // 1_000_000 + 1, 100_000))
    lattice = spark.range(0, total, 1, parts).select(
        F.floor(F.col("id") / F.lit(plane)).cast("int").alias("_g"),
        F.floor((F.col("id") % F.lit(plane)) / F.lit(n_cols)).cast("int").alias("row_ds"),
        (F.col("id") % F.lit(n_cols)).cast("int").alias("col_ds"),
    )
    if by:
        lattice = lattice.join(groups, "_g")
    return lattice.join(present, [*by, "row_ds", "col_ds"], "left").select(
        *by, "row_ds", "col_ds", F.coalesce("series", F.array_repeat(F.lit(None).cast("float"), n_dates)).alias("series")
    )


def cube_crop(cube: DataFrame, row_start: int, row_end: int, col_start: int, col_end: int) -> DataFrame:
    """Half-open crop in cell units; bounds past the end are not an error."""
    return cube.filter(
        (F.col("row_ds") >= row_start)
        & (F.col("row_ds") < row_end)
        & (F.col("col_ds") >= col_start)
        & (F.col("col_ds") < col_end)
    )


def cube_stride(cube: DataFrame, step: int, row0: int = 0, col0: int = 0) -> DataFrame:
    """Every ``step``-th row/col from (row0, col0), re-indexed as a mesh (x, y, z)."""
    s = cube.filter(
        ((F.col("row_ds") - row0) % step == 0)
        & ((F.col("col_ds") - col0) % step == 0)
        & (F.col("row_ds") >= row0)
        & (F.col("col_ds") >= col0)
    )
    return s.select(
        "t",
        "date",
        *[c for c in cube.columns if c == "tile_id"],
        ((F.col("col_ds") - col0) / step).cast("int").alias("x"),
        ((F.col("row_ds") - row0) / step).cast("int").alias("y"),
        F.col("t").alias("z"),
        "value",
    )


def cube_fill_zero(cube: DataFrame) -> DataFrame:
    return cube.withColumn("value", fill_missing("value", 0.0))


def cube_display_scale(cube: DataFrame, lo: float = -0.2, hi: float = 0.8) -> DataFrame:
    return cube.withColumn("value", clamp_keep_null("value", lo, hi))


def band_regrid(
    bands: DataFrame, keys: list[str], height: int, width: int, out_height: int, out_width: int, value: str = "value"
) -> DataFrame:
    """Average a band of ``height x width`` onto ``out_height x out_width`` cells, weighted by shared area.

    ``bands`` holds ``keys + (row, col, value)``.  Each pixel goes to the cells
    that it overlaps (a few at most when the target is coarser), then one
    aggregation.  Cells without a pixel are absent.  Places are 64-bit integers,
    since a row times a height passes 32 bits in a tall band.
    """
    def overlaps(index, size: int, out: int, name: str):
        index, size_, out_ = index.cast("long"), F.lit(size).cast("long"), F.lit(out).cast("long")

        def whole(x):
            return F.call_function("div", x - F.pmod(x, size_), size_)

        first = whole(index * out_)
        last = whole((index + 1) * out_ - 1)
        return F.explode(F.transform(F.sequence(first, last), lambda k: F.struct(
            k.cast("int").alias(name),
            (F.least((k + 1) * F.lit(size / out), index + 1) - F.greatest(k * F.lit(size / out), index)).alias("w"))))

    b = bands.select(*keys, "row", "col", F.col(value).cast("double").alias("_v"))
    b = b.withColumn("_r", overlaps(F.col("row"), height, out_height, "row_ds"))
    b = b.withColumn("_c", overlaps(F.col("col"), width, out_width, "col_ds"))
    weight = F.col("_r.w") * F.col("_c.w")
    return b.groupBy(*keys, F.col("_r.row_ds"), F.col("_c.col_ds")).agg(
        (F.sum(F.col("_v") * weight) / F.sum(weight)).alias(value))


def block_resample(
    bands: DataFrame,
    n: int,
    keys: list[str],
    height: int | None = None,
    width: int | None = None,
    value: str = "value",
    round_result: bool = False,
) -> DataFrame:
    """Block-average a band to 1/n resolution: full blocks only.

    ``bands`` holds ``keys + (row, col, value)`` at native resolution.  The
    output grid is ``height // n x width // n`` (extents default to the data's
    max index + 1), so a partial last block is dropped.  ``round_result``
    rounds the mean as an integer band would.
    """
    if height is None or width is None:
        ext = bands.agg((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w")).first()
        height = height if height is not None else int(ext.h or 0)
        width = width if width is not None else int(ext.w or 0)
    out_h, out_w = height // n, width // n
    b = bands.select(
        *keys,
        F.floor(F.col("row") / n).cast("int").alias("row_ds"),
        F.floor(F.col("col") / n).cast("int").alias("col_ds"),
        F.col(value).cast("double").alias("_v"),
    ).filter((F.col("row_ds") < out_h) & (F.col("col_ds") < out_w) & (F.col("row_ds") >= 0) & (F.col("col_ds") >= 0))
    m = F.avg("_v")
    if round_result:
        m = F.round(m, 0)
    return b.groupBy(*keys, "row_ds", "col_ds").agg(m.cast("float").alias(value))


def raster_explode(strips: DataFrame, keys: list[str], row: str = "row", array: str = "values", step: int = 1) -> DataFrame:
    """Strip arrays -> one row per valid element ``(keys, row, col, value)``.

    A strip is one raster row as ``ARRAY<FLOAT>``; valid means > 0 (0 is the
    no-data value).  Coordinates are multiplied by ``step`` (read-grid index
    -> native pixel).
    """
    e = strips.select(*keys, F.col(row).alias("_r"), F.posexplode(array).alias("_c", "value"))
    return e.filter(F.col("value") > 0).select(
        *keys,
        (F.col("_r") * step).cast("int").alias("row"),
        (F.col("_c") * step).cast("int").alias("col"),
        "value",
    )
