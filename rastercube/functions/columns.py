"""Small Column builders shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized_difference(a: str | Column, b: str | Column) -> Column:
    """``(a - b) / (a + b)`` as FLOAT, NULL where ``a + b <= 0``.

    Difference and sum are taken in the inputs' own type (FLOAT for bands),
    the quotient in DOUBLE and cast back to FLOAT, which equals a true
    float32 division.  The guard keeps ANSI mode from raising on a zero
    denominator; NULL (not NaN) marks the missing value.
    """
    a, b = col_(a), col_(b)
    den = a + b
    return F.when(den > 0, ((a - b).cast("double") / den.cast("double")).cast("float"))


def guarded_divide(num: str | Column, den: str | Column) -> Column:
    """``num / den`` where ``den > 0``, else NULL (never raises under ANSI)."""
    num, den = col_(num), col_(den)
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def trunc_div_int(c: str | Column, n: int) -> Column:
    """``int(c / n)``: divide, then truncate toward zero (not floor)."""
    if n <= 0:
        raise ValueError("divisor must be positive")
    return (col_(c).cast("double") / F.lit(float(n))).cast("int")


def clamp_keep_null(c: str | Column, lo: float, hi: float) -> Column:
    """Clamp into ``[lo, hi]``; NULL and NaN stay missing (NULL)."""
    c = col_(c)
    v = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return F.when(v.isNotNull(), F.greatest(F.least(v, F.lit(float(hi))), F.lit(float(lo))))


def fill_missing(c: str | Column, value: float = 0.0) -> Column:
    """Missing (NULL or NaN) -> ``value``."""
    c = col_(c)
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(float(value)))
