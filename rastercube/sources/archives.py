"""Archive member listing and band-file resolution.

Listing runs on the executors (``mapInArrow`` over a table of archive paths,
one task per slice of paths); only member names travel, never image bytes.
Resolution is a grouped arg-min over the listing with a priority column.
"""

from __future__ import annotations

from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.schema import ARCHIVE_LISTING

# Native-resolution band file pattern (strict) and the looser
# fall-back rule (contains ``_<band>_`` and ends with ``.jp2``).
STRICT_BAND = r"^.*IMG_DATA/R10m/.*_{band}_10m\{ext}$"
LOOSE_SUFFIX = ".jp2"


def _list_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zipfile

    for batch in batches:
        archives, ordinals, members, readable = [], [], [], []
        for path in batch.column("archive").to_pylist():
            try:
                with zipfile.ZipFile(path) as zf:
                    names = zf.namelist()
                ok = True
            except Exception:  # unreadable or truncated archive
                names, ok = [], False
            if not names:
                archives.append(path)
                ordinals.append(None)
                members.append(None)
                readable.append(ok)
            for i, name in enumerate(names):
                archives.append(path)
                ordinals.append(i)
                members.append(name)
                readable.append(ok)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(archives, pa.string()),
                pa.array(ordinals, pa.int32()),
                pa.array(members, pa.string()),
                pa.array(readable, pa.bool_()),
            ],
            names=["archive", "ordinal", "member", "readable"],
        )


def list_archives(paths: DataFrame, column: str = "path") -> DataFrame:
    """``(archive, ordinal, member, readable)``; an unreadable or empty
    archive yields one row with NULL member."""
    parts = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a manifest is one small file: deal the paths out before archives are opened
    return paths.select(F.col(column).alias("archive")).repartition(parts).mapInArrow(_list_batches, ARCHIVE_LISTING)


def archive_completeness(listing: DataFrame) -> DataFrame:
    """An archive is complete when it is readable and has at least one member."""
    return listing.groupBy("archive").agg(
        F.count("member").alias("n_members"),
        F.bool_and("readable").alias("readable"),
    ).withColumn("complete", F.col("readable") & (F.col("n_members") > 0))


def resolve_bands(listing: DataFrame, bands: list[str], on_missing: str = "error", ext: str = LOOSE_SUFFIX) -> DataFrame:
    """``(archive, band, member)``: the first strict match in listing order
    (ties on the ordinal broken by member name),
    else the first loose match; none -> error (or NULL with
    ``on_missing="null"``)."""
    lst = listing.filter(F.col("member").isNotNull()).select("archive", "ordinal", "member")
    lst = lst.select("*", F.explode(F.array(*[F.lit(b) for b in bands])).alias("band"))
    strict = F.lit(False)
    loose = F.lit(False)
    for b in bands:
        is_b = F.col("band") == b
        strict = strict | (is_b & F.col("member").rlike(STRICT_BAND.format(band=b, ext=ext)))
        loose = loose | (is_b & F.col("member").contains(f"_{b}_") & F.col("member").endswith(ext))
    prio = F.when(strict, 0).when(loose, 1)
    cand = lst.withColumn("prio", prio).filter(F.col("prio").isNotNull())
    found = cand.groupBy("archive", "band").agg(
        F.min_by("member", F.struct("prio", "ordinal", "member")).alias("member")
    )
    archives = listing.select("archive").distinct().select(
        "archive", F.explode(F.array(*[F.lit(b) for b in bands])).alias("band")
    )
    out = archives.join(found, ["archive", "band"], "left")
    if on_missing == "error":
        out = out.withColumn(
            "member",
            F.when(F.col("member").isNull(), F.raise_error(F.concat(F.lit("band "), F.col("band"), F.lit(" not found in "), F.col("archive")))).otherwise(F.col("member")),
        )
    elif on_missing != "null":
        raise ValueError("on_missing must be 'error' or 'null'")
    return out
