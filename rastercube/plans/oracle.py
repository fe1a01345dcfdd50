"""DuckDB SQL twins of ``plans.queries`` (tables are the driver's views).

Written independently of the Spark code, in plain SQL: the mapping views
first (``raw_obs``, ``obs``, ``means``, ``dense``, ``cat``), then one
statement per query.  Integer binning uses ``trunc`` (DuckDB's cast rounds),
percentiles use ``quantile_cont`` on DOUBLE, aggregated doubles are rounded
to 6 digits.
"""

from __future__ import annotations

from rastercube.plans import queries as Q
from rastercube.sources.testdata import TEST_BOXES

# Fixed values, stated here on their own: the projection's published series
# for WGS 84 (alpha 1 to 6, eccentricity, rectifying radius), zone 33, and the tile.
ALPHA = [0.0008377318206244698, 7.608527773572307e-07, 1.1976455033294527e-09,
         2.4291706072013587e-12, 5.711757677865804e-15, 1.4911177312583895e-17]
ECC_TERM = 0.08181919084262149
RECT_A = 6367449.145823415
UTM_FALSE_EASTING, UTM_K0, CENTRAL_MERIDIAN = 500000.0, 0.9996, 15.0
TILE_ORIGIN_X, TILE_ORIGIN_Y, PIXEL_SIZE, TILE_PIXELS = 300000.0, 4700040.0, 10.0, 10980

RAW_OBS = """raw_obs AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS date,
         CAST((l_orderkey % 100) * 10 AS INTEGER) AS row,
         CAST((l_partkey % 100) * 10 AS INTEGER) AS col,
         CAST(l_quantity * l_tax * 1000 AS FLOAT) AS red,
         CAST(l_extendedprice * l_discount / 10 AS FLOAT) AS nir
  FROM lineitem)"""

OBS = RAW_OBS + """,
obs AS (
  SELECT date, row, col, red, nir,
         CAST(CAST(nir - red AS DOUBLE) / CAST(nir + red AS DOUBLE) AS FLOAT) AS ndvi
  FROM raw_obs WHERE red > 0 AND nir > 0)"""


def measures(v: str = "ndvi", digits: int | None = 6) -> str:
    def r(x):
        return f"round({x}, {digits})" if digits is not None else x

    d = f"CAST({v} AS DOUBLE)"
    return (
        f"{r(f'avg({d})')} AS ndvi_mean, {r(f'stddev_samp({d})')} AS ndvi_std, "
        f"{r(f'quantile_cont({d}, 0.25)')} AS ndvi_p25, {r(f'quantile_cont({d}, 0.75)')} AS ndvi_p75, "
        f"count({v}) AS pixel_count"
    )


BOXES = "boxes(zone, row_min, row_max, col_min, col_max) AS (VALUES " + ", ".join(
    f"('{z}', {a}, {b}, {c}, {d})" for z, a, b, c, d in TEST_BOXES
) + ")"

ZONE_STATS_RAW = OBS + ",\n" + BOXES + f""",
zs AS (
  SELECT b.zone, o.date, {measures(digits=None)}
  FROM obs o JOIN boxes b
    ON o.row BETWEEN b.row_min AND b.row_max AND o.col BETWEEN b.col_min AND b.col_max
  GROUP BY b.zone, o.date)"""

ZONE_STATS = f"""WITH {ZONE_STATS_RAW}
SELECT zone, date, round(ndvi_mean, 6) AS ndvi_mean, round(ndvi_std, 6) AS ndvi_std,
       round(ndvi_p25, 6) AS ndvi_p25, round(ndvi_p75, 6) AS ndvi_p75, pixel_count
FROM zs"""

CUSTOMER_ZONES = """cz AS (
  SELECT c_name AS zone,
         12.0::DOUBLE + CAST(c_custkey % 1000 AS DOUBLE) / 1000.0::DOUBLE AS lon,
         41.5::DOUBLE + CAST(c_custkey % 997 AS DOUBLE) / 1000.0::DOUBLE AS lat,
         CAST((c_nationkey % 5) + 1 AS DOUBLE) AS radius_km
  FROM customer)"""


def _utm_sql(lon: str, lat: str) -> tuple[str, str, str, str]:
    """Krüger-series transverse Mercator written out as SQL text.

    Returns (easting, northing) in terms of columns ``xi_p``/``eta_p``, and
    the expressions for those two columns.
    """
    cm = CENTRAL_MERIDIAN
    phi = f"radians({lat})"
    lam = f"radians({lon} - {cm!r})"
    t = f"sinh(atanh(sin({phi})) - {ECC_TERM!r} * atanh({ECC_TERM!r} * sin({phi})))"
    xi_p = f"atan2({t}, cos({lam}))"
    eta_p = f"atanh(sin({lam}) / sqrt(1.0::DOUBLE + ({t}) * ({t})))"
    xi_terms = " + ".join(f"{a!r} * sin({2.0 * j!r} * xi_p) * cosh({2.0 * j!r} * eta_p)" for j, a in enumerate(ALPHA, 1))
    eta_terms = " + ".join(f"{a!r} * cos({2.0 * j!r} * xi_p) * sinh({2.0 * j!r} * eta_p)" for j, a in enumerate(ALPHA, 1))
    k = UTM_K0 * RECT_A
    easting = f"{UTM_FALSE_EASTING!r} + {k!r} * (eta_p + {eta_terms})"
    northing = f"{k!r} * (xi_p + {xi_terms})"
    return easting, northing, xi_p, eta_p


_E, _N, _XI, _ETA = _utm_sql("lon", "lat")
UTM = CUSTOMER_ZONES + f""",
pre AS (SELECT zone, lon, lat, radius_km, {_XI} AS xi_p, {_ETA} AS eta_p FROM cz),
utm AS (SELECT zone, lon, lat, radius_km, {_E} AS easting, {_N} AS northing FROM pre)"""

BOUNDS = UTM + f""",
raw_b AS (
  SELECT zone,
         CAST(trunc(({TILE_ORIGIN_Y!r} - (northing + radius_km * 1000.0)) / {PIXEL_SIZE!r}) AS INTEGER) AS row_min,
         CAST(trunc(({TILE_ORIGIN_Y!r} - (northing - radius_km * 1000.0)) / {PIXEL_SIZE!r}) AS INTEGER) AS row_max,
         CAST(trunc((easting - radius_km * 1000.0 - {TILE_ORIGIN_X!r}) / {PIXEL_SIZE!r}) AS INTEGER) AS col_min,
         CAST(trunc((easting + radius_km * 1000.0 - {TILE_ORIGIN_X!r}) / {PIXEL_SIZE!r}) AS INTEGER) AS col_max
  FROM utm)"""

MEANS = OBS + f""",
means AS (
  SELECT date, CAST(trunc(row / {Q.CUBE_BLOCK}) AS INTEGER) AS row_ds,
         CAST(trunc(col / {Q.CUBE_BLOCK}) AS INTEGER) AS col_ds,
         avg(CAST(ndvi AS DOUBLE)) AS ndvi_mean
  FROM obs GROUP BY 1, 2, 3),
ta AS (SELECT date, CAST(dense_rank() OVER (ORDER BY date) - 1 AS INTEGER) AS t FROM (SELECT DISTINCT date FROM means))"""

DENSE = MEANS + """,
ext AS (SELECT max(row_ds) + 1 AS nr, max(col_ds) + 1 AS nc FROM means),
lat AS (
  SELECT ta.t, ta.date, CAST(r.r AS INTEGER) AS row_ds, CAST(c.c AS INTEGER) AS col_ds
  FROM ta, ext, generate_series(0, ext.nr - 1) r(r), generate_series(0, ext.nc - 1) c(c)),
dense AS (
  SELECT l.t, l.date, l.row_ds, l.col_ds, CAST(m.ndvi_mean AS FLOAT) AS value
  FROM lat l LEFT JOIN means m ON m.date = l.date AND m.row_ds = l.row_ds AND m.col_ds = l.col_ds)"""

# Observations of four tiles (by supplier), two by two, 1,000 pixels of 100 m each way.
TILE_OBS = """tile_obs AS (
  SELECT 'T' || (l_suppkey % 4) AS tile_id, strftime(l_shipdate, '%Y-%m') AS date,
         CAST((l_orderkey % 100) * 10 AS INTEGER) AS row, CAST((l_partkey % 100) * 10 AS INTEGER) AS col,
         CAST(l_quantity * l_tax * 1000 AS FLOAT) AS red, CAST(l_extendedprice * l_discount / 10 AS FLOAT) AS nir
  FROM lineitem),
tobs AS (
  SELECT tile_id, date, row, col, CAST(CAST(nir - red AS DOUBLE) / CAST(nir + red AS DOUBLE) AS FLOAT) AS ndvi
  FROM tile_obs WHERE red > 0 AND nir > 0)"""
TILE_BOXES = UTM + """,
tiles(tile_id, ox, oy) AS (VALUES ('T0', 200000.0::DOUBLE, 4750040.0::DOUBLE), ('T1', 300000.0, 4750040.0),
                                  ('T2', 200000.0, 4650040.0), ('T3', 300000.0, 4650040.0)),
tb AS (
  SELECT zone, tile_id, greatest(CAST(floor((oy - (northing + radius_km * 1000.0)) / 100.0) AS INTEGER), 0) AS row_min,
         least(CAST(floor((oy - (northing - radius_km * 1000.0)) / 100.0) AS INTEGER), 999) AS row_max,
         greatest(CAST(floor((easting - radius_km * 1000.0 - ox) / 100.0) AS INTEGER), 0) AS col_min,
         least(CAST(floor((easting + radius_km * 1000.0 - ox) / 100.0) AS INTEGER), 999) AS col_max
  FROM utm, tiles),
boxes AS (SELECT * FROM tb WHERE row_min <= row_max AND col_min <= col_max)"""
TILE_DENSE = TILE_OBS + f""",
means AS (
  SELECT tile_id, date, CAST(trunc(row / {Q.CUBE_BLOCK}) AS INTEGER) AS row_ds,
         CAST(trunc(col / {Q.CUBE_BLOCK}) AS INTEGER) AS col_ds, avg(CAST(ndvi AS DOUBLE)) AS ndvi_mean
  FROM tobs GROUP BY 1, 2, 3, 4),
ta AS (SELECT date, CAST(dense_rank() OVER (ORDER BY date) - 1 AS INTEGER) AS t FROM (SELECT DISTINCT date FROM means)),
ext AS (SELECT max(row_ds) + 1 AS nr, max(col_ds) + 1 AS nc FROM means),
cells AS (SELECT CAST(r.r AS INTEGER) AS row_ds, CAST(c.c AS INTEGER) AS col_ds
          FROM ext, generate_series(0, ext.nr - 1) r(r), generate_series(0, ext.nc - 1) c(c))"""

R0, R1, C0, C1 = Q.CROP
CROPPED = DENSE + f""",
crop AS (SELECT * FROM dense WHERE row_ds >= {R0} AND row_ds < {R1} AND col_ds >= {C0} AND col_ds < {C1})"""

RASTER = """r AS (
  SELECT label, CAST(vec_id AS INTEGER) AS row, CAST(unnest(range(len(embedding))) AS INTEGER) AS col,
         unnest(embedding) AS value
  FROM embeddings)"""

PATHS = r"""p AS (
  SELECT CASE o_orderkey % 4
           WHEN 0 THEN 'C:\data\raw\S2_' || o_orderkey || '.zip'
           WHEN 1 THEN 'd:/tiles/' || o_orderstatus || '\S2_' || o_orderkey || '.zip'
           WHEN 2 THEN '/mnt/e/raw/S2_' || o_orderkey || '.zip'
           WHEN 3 THEN CASE WHEN o_orderkey % 8 = 3 THEN 'C:' ELSE '' END || 'S2_' || o_orderkey || '.zip'
           ELSE 'S2_' || o_orderkey || '.zip' END AS path
  FROM orders)"""

LISTING = """lst AS (
  SELECT 'S2_' || l_orderkey || '.zip' AS archive, CAST(l_linenumber AS INTEGER) AS ordinal,
         CASE l_partkey % 6
           WHEN 0 THEN 'S2.SAFE/GRANULE/L2A_' || l_suppkey || '/IMG_DATA/R10m/T33TTG_' || l_suppkey || '_B04_10m.jp2'
           WHEN 1 THEN 'S2.SAFE/GRANULE/L2A_' || l_suppkey || '/IMG_DATA/R20m/T33TTG_' || l_suppkey || '_B04_20m.jp2'
           WHEN 2 THEN 'S2.SAFE/GRANULE/L2A_' || l_suppkey || '/IMG_DATA/R10m/T33TTG_' || l_suppkey || '_B08_10m.jp2'
           WHEN 3 THEN 'S2.SAFE/GRANULE/L2A_' || l_suppkey || '/IMG_DATA/R60m/T33TTG_' || l_suppkey || '_B08_60m.jp2'
           WHEN 4 THEN 'S2.SAFE/GRANULE/L2A_' || l_suppkey || '/QI_DATA/MSK_CLDPRB_B04_20m.gml'
           ELSE 'S2.SAFE/MTD_MSIL2A.xml' END AS member
  FROM lineitem)"""

CC = ("CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 10000 AS VARCHAR) || '.' || "
      "lpad(CAST((CAST(round(o_totalprice * 100) AS BIGINT) % 10000) // 100 AS VARCHAR), 2, '0')")
PTYPE = "{'Name': 'productType', 'Value': CASE WHEN o_orderkey % 4 = 0 THEN 'S2MSI1C' ELSE 'S2MSI2A' END}"
CX = "(12.0::DOUBLE + CAST(o_custkey % 100 AS DOUBLE) / 100.0::DOUBLE)"
CY = "(41.5::DOUBLE + CAST(o_orderkey % 100 AS DOUBLE) / 100.0::DOUBLE)"
H = "0.3::DOUBLE"
NESTED = f"""cat AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS Id,
         'S2' || CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'B' END || '_MSIL2A_' || strftime(o_orderdate, '%Y%m%d') || '_' ||
           CASE o_custkey % 3 WHEN 0 THEN 'T33TTG' WHEN 1 THEN 'T33TUG' ELSE 'T32TQM' END AS Name,
         CASE WHEN starts_with(o_orderpriority, '5') THEN 'SENTINEL-1' ELSE 'SENTINEL-2' END AS Collection,
         o_orderdate AS start,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS start_iso,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN [{PTYPE}]
              WHEN o_orderstatus = 'P' THEN [{PTYPE}, {{'Name': 'cloudCover', 'Value': NULL::VARCHAR}}]
              ELSE [{PTYPE}, {{'Name': 'cloudCover', 'Value': {CC}}}] END AS Attributes,
         [{{'x': {CX} - {H}, 'y': {CY} - {H}}}, {{'x': {CX} + {H}, 'y': {CY} - {H} + 0.1::DOUBLE}},
          {{'x': {CX} + {H}, 'y': {CY} + {H}}}, {{'x': {CX} - {H} + 0.05::DOUBLE, 'y': {CY} + {H}}}] AS fp
  FROM orders)"""

FLAT = """fc AS (
  SELECT o_orderkey AS id, o_orderdate AS start, CAST(month(o_orderdate) AS INTEGER) AS month,
         CASE WHEN o_orderstatus = 'F' THEN 50.0::DOUBLE ELSE o_totalprice / 10000.0::DOUBLE END AS cloud
  FROM orders)"""


def _selection(n: int) -> str:
    months = ", ".join(str(m) for m in [1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12])
    return f"""WITH {FLAT},
c AS (SELECT * FROM fc),
best AS (SELECT id, start, month, cloud FROM (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY cloud, start, id) AS rn FROM c) WHERE rn = 1),
chosen AS (SELECT id, start, month, cloud FROM best WHERE month IN ({months})
           ORDER BY list_position([{months}], month) LIMIT {n}),
fill AS (SELECT id, start, month, cloud FROM (
  SELECT *, row_number() OVER (ORDER BY cloud, start, id) AS rn FROM c WHERE id NOT IN (SELECT id FROM chosen))
  WHERE rn <= {n} - (SELECT count(*) FROM chosen))
SELECT * FROM chosen UNION ALL SELECT * FROM fill"""


def _point_in_fp(px: float, py: float) -> str:
    prev = "fp[CASE WHEN i = 0 THEN len(fp) ELSE i END]"
    cur = "fp[i + 1]"
    straddle = f"(({cur}.y > {py!r}) <> ({prev}.y > {py!r}))"
    x_at = f"(({prev}.x - {cur}.x) * ({py!r} - {cur}.y) / nullif({prev}.y - {cur}.y, 0) + {cur}.x)"
    crosses = f"len(list_filter(range(len(fp)), lambda i: {straddle} AND ({px!r} < {x_at})))"
    bbox = (f"{px!r} >= list_min(list_transform(fp, lambda q: q.x)) AND {px!r} <= list_max(list_transform(fp, lambda q: q.x)) "
            f"AND {py!r} >= list_min(list_transform(fp, lambda q: q.y)) AND {py!r} <= list_max(list_transform(fp, lambda q: q.y))")
    return f"CASE WHEN len(fp) >= 3 THEN ({bbox}) AND {crosses} % 2 = 1 ELSE false END"


B0, B1, BC0, BC1 = Q.BBOX
N = Q.RESAMPLE_BLOCK
S = Q.STRIDE
ZONE_COLS = sorted(z for z, *_ in TEST_BOXES if z != "OFF")

ORACLE: dict[str, str] = {
    "ndvi_project": f"WITH {OBS} SELECT date, row, col, red, nir, ndvi FROM obs",
    "ndvi_guarded": f"""WITH {RAW_OBS}
SELECT date, row, col, red, nir,
       CASE WHEN nir + red > 0 THEN CAST(CAST(nir - red AS DOUBLE) / CAST(nir + red AS DOUBLE) AS FLOAT) END AS ndvi
FROM raw_obs""",
    "valid_mask": f"""WITH {RAW_OBS}
SELECT date, count(*) AS n_total, count(CASE WHEN red > 0 AND nir > 0 THEN 1 END) AS n_valid
FROM raw_obs GROUP BY date""",
    "obs_count": f"WITH {OBS} SELECT count(*) AS n_obs FROM obs",
    "date_stats": f"WITH {OBS} SELECT date, {measures()} FROM obs GROUP BY date ORDER BY date",
    "date_stats_approx": f"""WITH {OBS}
SELECT date, round(avg(CAST(ndvi AS DOUBLE)), 6) AS ndvi_mean, round(stddev_samp(CAST(ndvi AS DOUBLE)), 6) AS ndvi_std,
       count(ndvi) AS pixel_count, true AS ndvi_p25_near, true AS ndvi_p75_near FROM obs GROUP BY date""",
    "zone_stats": ZONE_STATS,
    "zone_stats_cells": ZONE_STATS,
    "zone_stats_union": ZONE_STATS,
    "date_and_zone_stats": f"""WITH {OBS},
cb AS (SELECT 'z' || c_custkey AS zone, (c_custkey * 37) % 900 AS r, (c_custkey * 53) % 900 AS c FROM customer)
SELECT b.zone, o.date, {measures()} FROM obs o JOIN cb b
  ON o.row BETWEEN b.r AND b.r + 20 AND o.col BETWEEN b.c AND b.c + 30 GROUP BY b.zone, o.date
UNION ALL SELECT '*' AS zone, date, {measures()} FROM obs GROUP BY date""",
    "zone_moments": f"""WITH {OBS},
cb AS (SELECT 'z' || c_custkey AS zone, (c_custkey * 37) % 900 AS r, (c_custkey * 53) % 900 AS c FROM customer)
SELECT b.zone, o.date, round(avg(CAST(ndvi AS DOUBLE)), 6) AS ndvi_mean,
       round(stddev_samp(CAST(ndvi AS DOUBLE)), 6) AS ndvi_std, count(ndvi) AS pixel_count FROM obs o JOIN cb b
  ON o.row BETWEEN b.r AND b.r + 20 AND o.col BETWEEN b.c AND b.c + 30 GROUP BY b.zone, o.date""",
    "morton_key": f"""WITH {OBS}
SELECT date, row, col, {" + ".join(f"((row::BIGINT >> {i} & 1) << {2 * i + 1}) + ((col::BIGINT >> {i} & 1) << {2 * i})" for i in range(16))} AS z
FROM obs""",
    "bbox_filter_clustered": f"""WITH {OBS}
SELECT date, row, col, ndvi FROM obs
WHERE row BETWEEN {B0} AND {B1} AND col BETWEEN {BC0} AND {BC1}""",
    "zone_utm": f"WITH {UTM} SELECT zone, round(easting, 3) AS easting, round(northing, 3) AS northing FROM utm",
    "zone_bounds": f"""WITH {BOUNDS}
SELECT zone, greatest(row_min, 0) AS row_min, greatest(row_max, 0) AS row_max,
       greatest(col_min, 0) AS col_min, greatest(col_max, 0) AS col_max,
       (row_min < 0 OR col_min < 0 OR row_max >= {TILE_PIXELS} OR col_max >= {TILE_PIXELS}) AS off_tile
FROM raw_b""",
    "bbox_filter": f"""WITH {OBS}
SELECT date, row, col, ndvi FROM obs
WHERE row BETWEEN {B0} AND {B1} AND col BETWEEN {BC0} AND {BC1}""",
    "zone_pivot": f"""WITH {ZONE_STATS_RAW}
SELECT date, {", ".join(f"max(CASE WHEN zone = '{z}' THEN round(ndvi_mean, 3) END) AS \"{z}\"" for z in ZONE_COLS)}
FROM zs GROUP BY date""",
    "zone_error_bars": f"""WITH {ZONE_STATS_RAW}
SELECT zone, date, round(ndvi_mean, 6) AS ndvi_mean, round(ndvi_p75 - ndvi_mean, 6) AS err_plus,
       round(ndvi_mean - ndvi_p25, 6) AS err_minus, round(ndvi_p25, 6) AS band_lo, round(ndvi_p75, 6) AS band_hi
FROM zs""",
    "zone_series": f"""WITH {ZONE_STATS_RAW}
SELECT zone, date, round(ndvi_mean, 6) AS ndvi_mean, round(ndvi_p75 - ndvi_mean, 6) AS err_plus,
       round(ndvi_mean - ndvi_p25, 6) AS err_minus, round(ndvi_p25, 6) AS band_lo, round(ndvi_p75, 6) AS band_hi,
       CAST(row_number() OVER (PARTITION BY zone ORDER BY date) - 1 AS INTEGER) AS pos
FROM zs""",
    "zone_tile_boxes": f"WITH {TILE_BOXES} SELECT zone, tile_id, row_min, row_max, col_min, col_max FROM boxes",
    "zone_stats_by_tile": f"""WITH {TILE_OBS},
{TILE_BOXES}
SELECT o.tile_id, b.zone, o.date, {measures()} FROM tobs o JOIN boxes b ON o.tile_id = b.tile_id
  AND o.row BETWEEN b.row_min AND b.row_max AND o.col BETWEEN b.col_min AND b.col_max GROUP BY o.tile_id, b.zone, o.date""",
    "zone_stats_tiles": f"""WITH {TILE_OBS},
{TILE_BOXES}
SELECT b.zone, o.date, {measures()} FROM tobs o JOIN boxes b ON o.tile_id = b.tile_id
  AND o.row BETWEEN b.row_min AND b.row_max AND o.col BETWEEN b.col_min AND b.col_max GROUP BY b.zone, o.date""",
    "cube_dense_by_tile": f"""WITH {TILE_DENSE}
SELECT ta.t, p.date, p.tile_id, c.row_ds, c.col_ds, CAST(m.ndvi_mean AS FLOAT) AS value
FROM (SELECT DISTINCT tile_id, date FROM means) p JOIN ta ON ta.date = p.date CROSS JOIN cells c
LEFT JOIN means m ON m.tile_id = p.tile_id AND m.date = p.date AND m.row_ds = c.row_ds AND m.col_ds = c.col_ds""",
    "cube_series_by_tile": f"""WITH {TILE_DENSE}
SELECT g.tile_id, c.row_ds, c.col_ds, list(CAST(m.ndvi_mean AS FLOAT) ORDER BY ta.t) AS series
FROM (SELECT DISTINCT tile_id FROM means) g CROSS JOIN cells c CROSS JOIN ta
LEFT JOIN means m ON m.tile_id = g.tile_id AND m.date = ta.date AND m.row_ds = c.row_ds AND m.col_ds = c.col_ds
GROUP BY g.tile_id, c.row_ds, c.col_ds""",
    "mosaic_block_mean": f"""WITH {TILE_OBS}
SELECT date, CAST(trunc((row + CASE WHEN tile_id IN ('T2', 'T3') THEN 1000 ELSE 0 END) / {Q.CUBE_BLOCK}) AS INTEGER) AS row_ds,
       CAST(trunc((col + CASE WHEN tile_id IN ('T1', 'T3') THEN 1000 ELSE 0 END) / {Q.CUBE_BLOCK}) AS INTEGER) AS col_ds,
       round(avg(CAST(ndvi AS DOUBLE)), 6) AS ndvi_mean
FROM tobs GROUP BY 1, 2, 3""",
    "cube_block_mean": f"WITH {MEANS} SELECT date, row_ds, col_ds, round(ndvi_mean, 6) AS ndvi_mean FROM means",
    "cube_extent": f"""WITH {MEANS}
SELECT CAST(max(row_ds) + 1 AS INTEGER) AS n_rows, CAST(max(col_ds) + 1 AS INTEGER) AS n_cols,
       CAST(count(DISTINCT date) AS INTEGER) AS n_dates FROM means""",
    "time_axis": f"""WITH {OBS}
SELECT date, CAST(dense_rank() OVER (ORDER BY date) - 1 AS INTEGER) AS t FROM (SELECT DISTINCT date FROM obs)""",
    "cube_time_index": f"""WITH {MEANS}
SELECT m.date, m.row_ds, m.col_ds, round(m.ndvi_mean, 6) AS ndvi_mean, ta.t FROM means m JOIN ta ON m.date = ta.date""",
    "cube_dense": f"WITH {DENSE} SELECT t, date, row_ds, col_ds, value FROM dense",
    "cube_slice": f"WITH {DENSE} SELECT t, date, row_ds, col_ds, value FROM dense WHERE t = {Q.SLICE_T}",
    "cube_series": f"WITH {DENSE} SELECT row_ds, col_ds, list(value ORDER BY t) AS series FROM dense GROUP BY row_ds, col_ds",
    "cube_crop": f"WITH {CROPPED} SELECT t, date, row_ds, col_ds, value FROM crop",
    "cube_stride": f"""WITH {CROPPED}
SELECT t, date, CAST((col_ds - {C0}) // {S} AS INTEGER) AS x, CAST((row_ds - {R0}) // {S} AS INTEGER) AS y, t AS z, value
FROM crop WHERE (row_ds - {R0}) % {S} = 0 AND (col_ds - {C0}) % {S} = 0""",
    "cube_fill_zero": f"""WITH {DENSE}
SELECT t, date, row_ds, col_ds, round(coalesce(CAST(value AS DOUBLE), 0.0), 6) AS value FROM dense""",
    "cube_display_scale": f"""WITH {DENSE}
SELECT t, date, row_ds, col_ds,
       round(CASE WHEN value IS NULL THEN NULL ELSE greatest(least(CAST(value AS DOUBLE), 0.8), -0.2) END, 6) AS value
FROM dense""",
    "block_resample": f"""WITH {RASTER},
ext AS (SELECT max(row) + 1 AS h, max(col) + 1 AS w FROM r)
SELECT label, CAST(floor(row / {N}) AS INTEGER) AS row_ds, CAST(floor(col / {N}) AS INTEGER) AS col_ds,
       CAST(avg(CAST(value AS DOUBLE)) AS FLOAT) AS value
FROM r, ext
WHERE floor(row / {N}) < ext.h // {N} AND floor(col / {N}) < ext.w // {N}
GROUP BY 1, 2, 3""",
    "band_regrid": f"""WITH {RASTER},
e AS (SELECT max(row) + 1 AS h, ((max(row) + 1) * 2) // 5 AS oh FROM r),
c AS (SELECT label, value, row, col, h / oh AS sr, 64.0::DOUBLE / 24 AS sc, i, j FROM r, e,
        LATERAL (SELECT unnest(range(CAST(row * oh // h AS BIGINT), CAST(ceil((row + 1) * oh / h) AS BIGINT))) AS i),
        LATERAL (SELECT unnest(range(CAST(col * 24 // 64 AS BIGINT), CAST(ceil((col + 1) * 24 / 64) AS BIGINT))) AS j)),
w AS (SELECT label, i, j, CAST(value AS DOUBLE) AS v,
             (least((i + 1) * sr, row + 1) - greatest(i * sr, row)) * (least((j + 1) * sc, col + 1) - greatest(j * sc, col)) AS a
      FROM c)
SELECT label, CAST(i AS INTEGER) AS row_ds, CAST(j AS INTEGER) AS col_ds, round(sum(v * a) / sum(a), 6) AS value
FROM w GROUP BY 1, 2, 3""",
    "raster_explode": """SELECT label, CAST(vec_id * 10 AS INTEGER) AS row, CAST(pos * 10 AS INTEGER) AS col, value
FROM (SELECT label, vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS value FROM embeddings)
WHERE value > 0""",
    "path_resolve": "WITH " + PATHS + r"""
SELECT path,
       CASE WHEN regexp_matches(path, '^([A-Za-z]):[/\\](.*)')
            THEN '/mnt/' || lower(regexp_extract(path, '^([A-Za-z]):[/\\](.*)', 1)) || '/' ||
                 regexp_replace(regexp_extract(path, '^([A-Za-z]):[/\\](.*)', 2), '\\', '/', 'g')
            ELSE path END AS local_path,
       '/data/raw/' || regexp_replace(list_last(string_split(replace(path, '\', '/'), '/')), '^[A-Za-z]:', '') AS pod_path
FROM p""",
    "band_resolve": "WITH " + LISTING + r""",
bands AS (SELECT unnest(['B04', 'B08']) AS band),
cand AS (
  SELECT archive, band, member, ordinal,
         CASE WHEN regexp_matches(member, '^.*IMG_DATA/R10m/.*_' || band || '_10m\.jp2$') THEN 0
              WHEN contains(member, '_' || band || '_') AND ends_with(member, '.jp2') THEN 1 END AS prio
  FROM lst, bands),
ranked AS (
  SELECT archive, band, member, row_number() OVER (PARTITION BY archive, band ORDER BY prio, ordinal, member) AS rn
  FROM cand WHERE prio IS NOT NULL),
arch AS (SELECT DISTINCT archive FROM lst)
SELECT a.archive, b.band, r.member
FROM arch a CROSS JOIN bands b LEFT JOIN ranked r ON r.archive = a.archive AND r.band = b.band AND r.rn = 1""",
    "cloud_cover_extract": f"""WITH {NESTED}
SELECT Id, CASE WHEN list_filter(Attributes, lambda a: a.Name = 'cloudCover')[1] IS NULL THEN 50.0::DOUBLE
                ELSE coalesce(CAST(list_filter(Attributes, lambda a: a.Name = 'cloudCover')[1].Value AS DOUBLE), 100.0::DOUBLE)
           END AS cloud
FROM cat""",
    "catalog_max_cloud": f"""WITH {NESTED},
c AS (SELECT *, CASE WHEN list_filter(Attributes, lambda a: a.Name = 'cloudCover')[1] IS NULL THEN 50.0::DOUBLE
                ELSE coalesce(CAST(list_filter(Attributes, lambda a: a.Name = 'cloudCover')[1].Value AS DOUBLE), 100.0::DOUBLE)
           END AS cloud FROM cat)
SELECT Id, Name FROM c WHERE Collection = 'SENTINEL-2' AND cloud < 20.0
  AND coalesce(len(list_filter(Attributes, lambda a: a.Name = 'productType' AND a.Value = 'S2MSI2A')) > 0, false)""",
    "catalog_filter": f"""WITH {NESTED}
SELECT Id, Name, start_iso FROM cat
WHERE Collection = 'SENTINEL-2' AND start > TIMESTAMP '{Q.SEARCH_WINDOW[0]}' AND start < TIMESTAMP '{Q.SEARCH_WINDOW[1]}'
  AND coalesce(len(list_filter(Attributes, lambda a: a.Name = 'productType' AND a.Value = 'S2MSI2A')) > 0, false)
  AND contains(Name, 'T33TTG')""",
    "footprint_contains": f"WITH {NESTED} SELECT Id, {_point_in_fp(*Q.POINT)} AS inside FROM cat",
    "acq_date_parts": f"""WITH {NESTED}
SELECT Id, substr(start_iso, 1, 10) AS day, CAST(month(start) AS INTEGER) AS month, substr(start_iso, 6, 5) AS mmdd
FROM cat""",
    "catalog_by_month": f"""WITH {FLAT}
SELECT month, count(*) AS n_products, round(min(cloud), 6) AS min_cloud, min(start) AS first_start FROM fc GROUP BY month""",
    "month_best": f"""WITH {FLAT}
SELECT month, id, start, cloud FROM (
  SELECT *, row_number() OVER (PARTITION BY month ORDER BY cloud, start, id) AS rn FROM fc) WHERE rn = 1""",
    "select_acquisitions": _selection(8),
    "select_acquisitions_fill": _selection(20),
}
