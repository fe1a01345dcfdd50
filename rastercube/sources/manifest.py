"""Acquisition manifest: JSON read (array file or Spark JSON lines) and write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.functions.paths import resolve_path
from rastercube.schema import MANIFEST


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``(id, name, date, cloud_cover, path)``.  ``multi_line=True`` reads a
    JSON array document; ``False`` reads JSON lines (as written by
    ``write_manifest``).  A missing path is an error, and so is malformed JSON."""
    return spark.read.schema(MANIFEST).option("multiLine", multi_line).option("mode", "FAILFAST").json(path)


def tile_records(manifest: DataFrame, data_dir: str | None = None) -> DataFrame:
    """Loader input: resolved archive path and acquisition date."""
    return manifest.select(resolve_path("path", data_dir).alias("path"), F.col("date"), F.col("name"))


def write_manifest(entries: DataFrame, path: str) -> None:
    """Selected acquisitions as one JSON-lines file, sorted by date."""
    entries.select(*[f.name for f in MANIFEST.fields]).orderBy("date", "id").coalesce(1).write.mode(
        "overwrite"
    ).json(path)
