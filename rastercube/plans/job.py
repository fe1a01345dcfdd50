"""End-to-end job: load -> date statistics -> zone statistics -> cube -> chart tables.

The steps follow the reference's run order; every output is written by the
executors (Parquet / CSV), nothing is gathered on the driver except bounded
dimension tables (manifest, zones, dates) and one-line timing prints.

Chart inputs are produced as tables instead of pictures: the per-zone
series with error bars, the display-clamped time slices and the cropped,
strided and zero-filled mesh.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.operators import grid, mosaic, zones
from rastercube.schema import TILES
from rastercube.sources import store
from rastercube.sources.manifest import read_manifest, tile_records
from rastercube.sources.tiles import index_tiles, load_tiles

# The map crop in cube cells (rows [0, 870), cols [240, 1098))
# and the mesh stride used for the 3-D view.
CROP = (0, 870, 240, 1098)
MESH_STRIDE = 6


@dataclass
class JobResult:
    out_dir: str
    timings: dict[str, float] = field(default_factory=dict)


def _timed(res: JobResult, name: str, fn):
    t0 = time.time()
    out = fn()
    res.timings[name] = round(time.time() - t0, 3)
    return out


MAX_PIVOT_ZONES = 1_000  # zone columns of a pivot table


def write_pivots(stats: DataFrame, zone_names: DataFrame, path: str, most: int | None = None) -> int:
    """The date x zone tables, ``most`` zones each in their order: one at ``path``, or, of several, ``path/part=k``.

    Only one table's zone names are on the driver at a time.  Returns the number of tables.
    """
    most = most or MAX_PIVOT_ZONES
    zone_names = zone_names.select("zone").where("zone is not null").distinct()
    last, part = None, 0
    while True:
        rest = zone_names if last is None else zone_names.where(F.col("zone") > last)
        names = [r.zone for r in rest.orderBy("zone").limit(most + 1).collect()]
        more, names = len(names) > most, names[:most]
        if not names and part:
            return part
        mine = stats.where(F.col("zone").between(names[0], names[-1])) if names else stats.limit(0)
        table = zones.zone_pivot(mine, names=names or None)
        store.write_csv(table, os.path.join(path, f"part={part}") if more or part else path)
        if not more:
            return part + 1
        last, part = names[-1], part + 1


def load_observations(
    spark: SparkSession, manifest_path: str, data_dir: str | None = None, multi_line: bool = True,
    index: str | None = None, **tile_options
) -> DataFrame:
    """Manifest -> tile strips scanned on the executors -> observation rows.

    ``index`` is a folder beside the store for access points of compressed
    bands: bands that it lacks are indexed first (one pass over each), then the
    strips of every raster are dealt out.
    """
    return _scan(spark, tile_records(read_manifest(spark, manifest_path, multi_line), data_dir), index, **tile_options)


def _scan(spark: SparkSession, records: DataFrame, index: str | None, **tile_options) -> DataFrame:
    if index is None:
        return load_tiles(spark, records, **tile_options)
    known = store.read_index(spark, index) if store.exists(spark, index) else None
    # written before it is read: the files of ``known`` stay as they are
    store.write_index(index_tiles(spark, records, tile_options.get("decoder", "npy"), known=known), index)
    return load_tiles(spark, records, points=store.read_index(spark, index), **tile_options)


def load_new(
    spark: SparkSession, manifest_path: str, store_path: str, data_dir: str | None = None, multi_line: bool = True,
    index: str | None = None, **tile_options
) -> int:
    """Load the manifest's acquisitions that the store at ``store_path`` lacks; returns their number.

    The store has a folder for each (date, tile), so a rerun reads no tile, a
    new acquisition adds one folder and changes no other, and a load that failed
    can simply be repeated.  An acquisition without any valid pixel leaves no
    folder and is read again the next time.  Read the store by
    ``store.read_observations(..., with_tile=True, clustered=True)``.
    """
    records = tile_records(read_manifest(spark, manifest_path, multi_line), data_dir)
    if store.exists(spark, store_path):
        # a tile without a name goes by its path, as in the tile scan
        have = store.acquisitions(spark, store_path).withColumnRenamed("tile_id", "_id")
        name = F.coalesce(records["name"], records["path"]) if "name" in records.columns else records["path"]
        records = records.join(have, (records["date"] == have["date"]) & (name == have["_id"]), "left_anti")
    n = records.count()
    if n:
        store.append_acquisitions(_scan(spark, records, index, **tile_options), store_path)
    return n


def check_tiles(obs: DataFrame, tiles: DataFrame | None) -> None:
    """Observations must be of one tile, or all of tiles that the dimension has."""
    seen = obs.select("tile_id").distinct()
    if tiles is not None:
        unknown = seen.join(tiles.select("tile_id"), "tile_id", "left_anti").limit(5).collect()
        if unknown:
            raise ValueError(f"not in the tile dimension: {sorted(str(r.tile_id) for r in unknown)}")
    elif len(codes := seen.select(mosaic.tile_code("tile_id").alias("c")).where("c is not null").distinct().limit(5).collect()) > 1:
        raise ValueError(f"several tiles ({sorted(r.c for r in codes)}, ...) need a tile dimension")


def run(
    spark: SparkSession,
    obs: DataFrame,
    out_dir: str,
    boxes: DataFrame | None = None,
    block: int = 10,
    crop: tuple[int, int, int, int] = CROP,
    stride: int = MESH_STRIDE,
    method: str = "auto",
    tiles: DataFrame | None = None,
) -> JobResult:
    """Run the job over an observation DataFrame, writing every result.

    Observations of one tile need no ``tiles``.  Those of several need the
    tile dimension (``schema.TILES``): zones are then placed in every tile
    that they reach, and the cube has planes of its own for each tile.

    ``obs`` is first written to the flat observation store (date folders,
    row-clustered files) and every later step reads the store back, so a
    lost executor recomputes from Parquet, never from the tile decoder.
    """
    res = JobResult(out_dir)
    obs_path = os.path.join(out_dir, "observations")
    if tiles is not None:
        obs = obs.withColumn("tile_id", F.coalesce(mosaic.tile_code("tile_id"), F.col("tile_id")))
    cols = [c for c in ("tile_id", "date", "row", "col", "red", "nir", "ndvi") if c in obs.columns]
    _timed(res, "load", lambda: store.write_observations(obs.select(*cols), obs_path, clustered=True))
    o = store.read_observations(spark, obs_path, with_tile="tile_id" in cols, clustered=True)

    by = [] if tiles is None else ["tile_id"]
    if "tile_id" in cols:
        check_tiles(o, tiles)
    if boxes is None:
        centres = zones.reference_zones(spark)
        boxes = zones.zone_pixel_bounds(centres) if tiles is None else mosaic.zone_tile_boxes(centres, tiles)
    zpath = os.path.join(out_dir, "zone_stats")

    def stats_step():
        by_date, by_zone = zones.date_and_zone_stats(o, boxes, method=method)
        store.write_csv(by_date, os.path.join(out_dir, "global_stats"))
        store.write_csv(by_zone, zpath)

    _timed(res, "statistics", stats_step)
    zs = store.read_stats_csv(spark, zpath, zones=True, parse_dates=False)
    write_pivots(zs, boxes, os.path.join(out_dir, "zone_pivot"))
    zs.transform(zones.zone_series).write.mode("overwrite").parquet(os.path.join(out_dir, "zone_series"))

    cube_dir = os.path.join(out_dir, "cube")

    def cube_step():
        means = grid.block_means(o, block, by=by)
        # extent from two integer columns of the store, not from the means
        cube = grid.dense_cube(means, extent=grid.extent_from_obs(o, block), by_time=True, by=by)
        store.write_cube(cube, cube_dir, dates=grid.time_axis(o), laid_out=True)

    _timed(res, "cube", cube_step)
    cube, _ = store.read_cube(spark, cube_dir, with_tile=bool(by))

    def charts():
        grid.cube_display_scale(cube).write.mode("overwrite").partitionBy("t").parquet(os.path.join(out_dir, "maps"))
        mesh = grid.cube_fill_zero(grid.cube_stride(grid.cube_crop(cube, *crop), stride, crop[0], crop[2]))
        mesh.write.mode("overwrite").parquet(os.path.join(out_dir, "mesh"))

    _timed(res, "chart_tables", charts)
    return res


def select_to_manifest(
    spark: SparkSession,
    products_path: str,
    out_path: str,
    path_prefix: str,
    tile: str | None = "T33TTG",
    start_after: str | None = None,
    start_before: str | None = None,
    max_cloud: float | None = None,
    n: int = 8,
    point: tuple[float, float] | None = None,
) -> DataFrame:
    """Catalogue products (JSON, one product per line) -> predicates ->
    acquisition choice -> manifest written as JSON lines.  Returns the
    selected products."""
    from rastercube.operators import catalog as cat
    from rastercube.schema import CATALOG_PRODUCT
    from rastercube.sources.manifest import write_manifest

    products = spark.read.schema(CATALOG_PRODUCT).option("mode", "FAILFAST").json(products_path)
    products = products.withColumn("start", F.to_timestamp("ContentDate.Start"))
    found = cat.catalog_filter(
        products, start_after=start_after, start_before=start_before, name_contains=tile, max_cloud=max_cloud
    )
    if point is not None:  # only products whose footprint holds the (lon, lat)
        found = found.filter(cat.footprint_contains(*point))
    chosen = cat.select_acquisitions(cat.flatten(found), n=n)
    write_manifest(cat.manifest_rows(chosen, path_prefix), out_path)
    return chosen


def main(argv: list[str] | None = None) -> None:
    import argparse

    from rastercube.session import build_session

    ap = argparse.ArgumentParser(prog="python -m rastercube.plans.job")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sel = sub.add_parser("select", help="choose acquisitions from a catalogue and write the manifest")
    sel.add_argument("--products", required=True)
    sel.add_argument("--out", required=True)
    sel.add_argument("--path-prefix", default="")
    sel.add_argument("--tile", default="T33TTG")
    sel.add_argument("--after")
    sel.add_argument("--before")
    sel.add_argument("--max-cloud", type=float)
    sel.add_argument("--point", type=float, nargs=2, metavar=("LON", "LAT"))
    run_p = sub.add_parser("run", help="load tiles and write statistics, cube and chart tables")
    run_p.add_argument("--manifest", required=True)
    run_p.add_argument("--out", required=True)
    run_p.add_argument("--data-dir")
    run_p.add_argument("--json-lines", action="store_true", help="manifest written by 'select' (JSON lines)")
    run_p.add_argument("--block", type=int, default=10)
    run_p.add_argument("--index", help="folder for access points of compressed bands, made and kept up")
    run_p.add_argument("--tiles", help="tile dimension, one JSON object a line (needed for several tiles)")
    run_p.add_argument("--method", default="auto", choices=["auto", "exact", "builtin", "approx"])
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "select":
        chosen = select_to_manifest(
            spark, args.products, args.out, args.path_prefix, args.tile, args.after, args.before, args.max_cloud,
            point=tuple(args.point) if args.point else None,
        )
        store.preview(chosen)
    else:
        obs = load_observations(spark, args.manifest, args.data_dir, multi_line=not args.json_lines, index=args.index)
        tiles = spark.read.schema(TILES).option("mode", "FAILFAST").json(args.tiles) if args.tiles else None
        res = run(spark, obs, args.out, block=args.block, method=args.method, tiles=tiles)
        for k, v in res.timings.items():
            print(f"{k:14s} {v:8.1f} s")
    spark.stop()


if __name__ == "__main__":
    main()
