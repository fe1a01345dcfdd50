"""WGS84 longitude/latitude -> UTM easting/northing as Spark Column maths.

Transverse Mercator by the Krüger series in the third flattening ``n``
(6th order, millimetre-accurate inside a UTM zone).  Every step is a
built-in function (``sin, atanh, sinh, atan2, cosh``), so the projection runs
inside whole-stage codegen with no Python on the row path.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from rastercube.functions.columns import col_

# WGS84 ellipsoid and the UTM convention.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0


def _series(n: float) -> tuple[float, list[float]]:
    """Rectifying radius ``A`` and the forward coefficients alpha_1..alpha_6."""
    n2, n3, n4, n5, n6 = n**2, n**3, n**4, n**5, n**6
    big_a = WGS84_A / (1 + n) * (1 + n2 / 4 + n4 / 64 + n6 / 256)
    alpha = [
        n / 2 - 2 * n2 / 3 + 5 * n3 / 16 + 41 * n4 / 180 - 127 * n5 / 288 + 7891 * n6 / 37800,
        13 * n2 / 48 - 3 * n3 / 5 + 557 * n4 / 1440 + 281 * n5 / 630 - 1983433 * n6 / 1935360,
        61 * n3 / 240 - 103 * n4 / 140 + 15061 * n5 / 26880 + 167603 * n6 / 181440,
        49561 * n4 / 161280 - 179 * n5 / 168 + 6601661 * n6 / 7257600,
        34729 * n5 / 80640 - 3418889 * n6 / 1995840,
        212378941 * n6 / 319334400,
    ]
    return big_a, alpha


N3 = WGS84_F / (2 - WGS84_F)
RECT_A, ALPHA = _series(N3)
ECC_TERM = 2 * math.sqrt(N3) / (1 + N3)


def central_meridian(zone: int) -> float:
    return (zone - 1) * 6 - 180 + 3


def utm_columns(lon: str | Column, lat: str | Column, zone: int = 33, south: bool = False) -> tuple[Column, Column]:
    """(easting, northing) in metres for degrees ``lon``/``lat``."""
    phi = F.radians(col_(lat).cast("double"))
    lam = F.radians(col_(lon).cast("double") - F.lit(central_meridian(zone)))
    sphi = F.sin(phi)
    t = F.sinh(F.atanh(sphi) - F.lit(ECC_TERM) * F.atanh(F.lit(ECC_TERM) * sphi))
    xi_p = F.atan2(t, F.cos(lam))
    eta_p = F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    xi, eta = xi_p, eta_p
    for j, a in enumerate(ALPHA, start=1):
        xi = xi + F.lit(a) * F.sin(F.lit(2.0 * j) * xi_p) * F.cosh(F.lit(2.0 * j) * eta_p)
        eta = eta + F.lit(a) * F.cos(F.lit(2.0 * j) * xi_p) * F.sinh(F.lit(2.0 * j) * eta_p)
    k = UTM_K0 * RECT_A
    easting = F.lit(UTM_FALSE_EASTING) + F.lit(k) * eta
    northing = F.lit(k) * xi + (F.lit(UTM_FALSE_NORTHING_SOUTH) if south else F.lit(0.0))
    return easting, northing
