"""Band maths over observation rows: NDVI, guarded ratio, validity mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastercube.functions.columns import col_, normalized_difference

NATIVE_STEP = 10  # native 10 m pixels per 100 m read block


def valid_mask(red: str | Column = "red", nir: str | Column = "nir") -> Column:
    """A pixel is kept when both bands are strictly positive (0 = no data)."""
    return (col_(red) > 0) & (col_(nir) > 0)


def with_ndvi(
    df: DataFrame,
    red: str = "red",
    nir: str = "nir",
    out: str = "ndvi",
    scale: float | None = None,
    offset: float | None = None,
) -> DataFrame:
    """Add the normalized difference ``(nir - red) / (nir + red)`` as FLOAT.

    ``scale``/``offset`` optionally turn digital numbers into reflectance
    first (``dn * scale + offset``); by default raw numbers are used, as the
    reference does.
    """
    r, n = F.col(red), F.col(nir)
    if scale is not None or offset is not None:
        s = F.lit(float(1.0 if scale is None else scale)).cast("float")
        o = F.lit(float(0.0 if offset is None else offset)).cast("float")
        r, n = (r * s + o).cast("float"), (n * s + o).cast("float")
    return df.withColumn(out, normalized_difference(n, r))


def mask_valid(df: DataFrame, red: str = "red", nir: str = "nir", extra: Column | None = None) -> DataFrame:
    """Drop invalid pixels; ``extra`` is an optional boolean mask (e.g. clouds)."""
    cond = valid_mask(red, nir)
    if extra is not None:
        cond = cond & F.coalesce(extra, F.lit(False))
    return df.filter(cond)


def index_to_native(idx: str | Column, step: int = NATIVE_STEP) -> Column:
    """Read-grid index -> native pixel coordinate (``idx * step``) as INT."""
    return (col_(idx) * F.lit(step)).cast("int")
