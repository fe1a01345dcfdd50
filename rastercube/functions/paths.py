"""Archive path mapping as Column expressions (runs on executors, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rastercube.functions.columns import col_

# A drive-letter path, and the mount point it maps to.
DRIVE_PATH = r"^([A-Za-z]):[/\\](.*)"
MOUNT_ROOT = "/mnt/"


def basename(path: str | Column) -> Column:
    """Last component, splitting on both ``/`` and ``\\``; the drive of a
    drive-relative name (``C:name``) is not part of it."""
    return F.regexp_extract(col_(path), r"^(?:[A-Za-z]:)?(?:.*[/\\])?([^/\\]*)$", 1)


def drive_to_mount(path: str | Column) -> Column:
    """``X:\\a\\b`` or ``X:/a/b`` -> ``/mnt/x/a/b``; other paths unchanged."""
    p = col_(path)
    m = p.rlike(DRIVE_PATH)
    drive = F.lower(F.regexp_extract(p, DRIVE_PATH, 1))
    rest = F.regexp_replace(F.regexp_extract(p, DRIVE_PATH, 2), r"\\", "/")
    return F.when(m, F.concat(F.lit(MOUNT_ROOT), drive, F.lit("/"), rest)).otherwise(p)


def resolve_path(path: str | Column, data_dir: str | None = None) -> Column:
    """Where a worker finds an archive: ``data_dir/basename`` when a data
    folder is set, else the drive-letter mapping."""
    if data_dir:
        return F.concat(F.lit(data_dir.rstrip("/") + "/"), basename(path))
    return drive_to_mount(path)
