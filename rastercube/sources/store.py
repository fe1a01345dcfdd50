"""Parquet observation store, statistics CSVs, cube store (sinks and re-reads).

The observation store is rebalanced on ``date`` by adaptive execution (hot
dates split by size, small ones merged), sorted by row within files and laid
out as ``date=...`` folders, so a date filter prunes folders and a
``row``/``col`` box prunes row groups by their min/max statistics.  Every reader passes an explicit schema (no inference, and the
``date`` partition value stays a string).
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions import morton
from rastercube.schema import DATE_STATS, OBSERVATION, ZONE_STATS

CUBE_SCHEMA = "t INT, date STRING, row_ds INT, col_ds INT, value FLOAT"
DATES_SCHEMA = "t INT, date STRING"
ROW_GROUP_BYTES = 4 << 20


def materialize(df: DataFrame) -> DataFrame:
    """Persist (memory, spilling to disk) and force with a row count."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df


def write_observations(
    obs: DataFrame,
    path: str,
    partitions: int | None = None,
    max_records_per_file: int = 5_000_000,
    mode: str = "overwrite",
    clustered: bool = False,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Flat observation store: ``date=...`` folders, files sorted by row.

    ``clustered`` sorts files by the Morton key of (row, col) instead and
    stores it as ``z``, in row groups of ``row_group_bytes``: a box then prunes
    by rows and columns alike (see :func:`read_observations`).

    The ``rebalance`` hint lets adaptive execution hash the rows by date,
    merge small dates into one task and split a date that holds a large share
    of the pixels into tasks of the advisory size -- so each task writes one
    or few date folders (no small-file explosion), a hot date is spread, and
    no sampling pass re-reads the input (which, straight from the tile
    source, would decode every tile twice).  ``partitions`` forces an exact
    hash partitioning on (date, row block) instead.
    """
    if clustered:
        obs = obs.withColumn(morton.KEY, morton.morton_key())
    place = [morton.KEY] if clustered else ["row", "col"]
    keep = [c for c in obs.columns if c != "date"]
    if partitions:
        laid = obs.repartition(partitions, F.col("date"), F.floor(F.col("row") / 500))
    else:
        laid = obs.hint("rebalance", "date")
    out = laid.sortWithinPartitions("date", *place).select(*keep, "date").write.mode(mode)
    if clustered:
        out = out.option("parquet.block.size", row_group_bytes)
    (
        out.option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("date")
        .parquet(path)
    )


def append_acquisitions(obs: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Add acquisitions to a store of ``date=.../tile_id=...`` folders, clustered by the Morton key.

    A folder that is there already is replaced as a whole (dynamic partition
    overwrite), the others stay as they are; so writing the same acquisitions
    again, after a failure say, leaves the same store.
    """
    keyed = obs.withColumn(morton.KEY, morton.morton_key()).hint("rebalance", "date", "tile_id")
    keep = [c for c in keyed.columns if c not in ("date", "tile_id")]
    (
        keyed.sortWithinPartitions("date", "tile_id", morton.KEY).select(*keep, "date", "tile_id")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
        .partitionBy("date", "tile_id").parquet(path)
    )


def acquisitions(spark: SparkSession, path: str) -> DataFrame:
    """The ``(date, tile_id)`` folders of such a store: no column of any file is read."""
    return read_observations(spark, path, with_tile=True, clustered=True).select("date", "tile_id").distinct()


def read_observations(spark: SparkSession, path: str, with_tile: bool = False, clustered: bool = False) -> DataFrame:
    """The store's observations.  With ``clustered`` they keep the key ``z``, by which
    ``zones.bbox_filter`` and the zone operators turn boxes into key ranges for the scan."""
    fields = list(OBSERVATION.fields)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields if f.name != "date")
    if with_tile:
        ddl = "tile_id string, " + ddl
    if clustered:
        ddl += f", {morton.KEY} bigint"
    ddl += ", date string"
    df = spark.read.schema(ddl).parquet(path)
    cols = (["tile_id"] if with_tile else []) + [f.name for f in fields] + ([morton.KEY] if clustered else [])
    return df.select(*cols)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def write_index(points: DataFrame, path: str, mode: str = "append") -> None:
    """Access points of compressed bands (``tiles.index_tiles``), beside the store."""
    points.write.mode(mode).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    from rastercube.sources.tiles import INDEX_DDL

    return spark.read.schema(INDEX_DDL).parquet(path)


ONE_FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """A result table as CSV with a header row: one file if it has few rows, else one a task."""
    df = df.coalesce(1) if df.limit(ONE_FILE_ROWS + 1).count() <= ONE_FILE_ROWS else df
    df.write.mode("overwrite").option("header", True).csv(path)


def read_stats_csv(spark: SparkSession, path: str, zones: bool = False, parse_dates: bool = True) -> DataFrame:
    """Statistics CSV back as a table; ``date`` parsed to DATE when asked."""
    schema = ZONE_STATS if zones else DATE_STATS
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    if parse_dates:
        df = df.withColumn("date", F.to_date("date"))
    return df


def write_cube(
    cube: DataFrame, path: str, partitions: int | None = None, dates: DataFrame | None = None, row_block: int = 16,
    laid_out: bool = False,
) -> None:
    """Dense cube partitioned by time index, plus the ordered ``dates`` table.

    Rows are rebalanced on ``t`` by adaptive execution (a large time plane is
    split by size, small ones merged; no sampling pass that would recompute
    the cube), and files are sorted by row for row-group pruning.
    A cube from ``dense_cube(by_time=True)`` is ``laid_out`` already: its
    strips were rebalanced before they became rows, and no row is shuffled.
    ``partitions`` forces a hash partitioning on ``(t, row_ds // row_block)``.  ``dates`` is the
    ``(t, date)`` axis; without it the axis is read back from the written
    files.
    """
    tile = [c for c in cube.columns if c == "tile_id"]
    c = cube.select(*tile, "row_ds", "col_ds", "value", "date", "t")
    if partitions:
        c = c.repartition(partitions, F.col("t"), F.floor(F.col("row_ds") / row_block))
    elif not laid_out:
        c = c.hint("rebalance", "t")
    (
        c.sortWithinPartitions("t", *tile, "row_ds", "col_ds")
        .write.mode("overwrite")
        .partitionBy("t")
        .parquet(os.path.join(path, "cube"))
    )
    if dates is None:
        # read (t, date) back from the written files instead of recomputing the cube
        dates = cube.sparkSession.read.parquet(os.path.join(path, "cube")).select("t", "date").distinct()
    dates.select("t", "date").coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "dates"))


def read_cube(spark: SparkSession, path: str, with_tile: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(cube, dates)``; a filter on ``t`` prunes to one folder."""
    tile = ["tile_id"] if with_tile else []
    cube = spark.read.schema("".join(f"{c} STRING, " for c in tile) + "row_ds INT, col_ds INT, value FLOAT, date STRING, t INT").parquet(
        os.path.join(path, "cube")
    )
    dates = spark.read.schema(DATES_SCHEMA).parquet(os.path.join(path, "dates")).orderBy("t")
    return cube.select("t", "date", *tile, "row_ds", "col_ds", "value"), dates


def preview(df: DataFrame, n: int = 20, schema: bool = False) -> None:
    """Console preview (a bounded ``show``)."""
    if schema:
        df.printSchema()
    df.show(n, truncate=False)
