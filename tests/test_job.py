import json
import os

from pyspark.sql import functions as F

from rastercube.operators.stats import date_stats
from rastercube.plans import job
from rastercube.sources import store
from test_sources import _tiles


def test_job_end_to_end_on_tiles(spark, tmpdir_path):
    tiles = _tiles(tmpdir_path)
    manifest = os.path.join(tmpdir_path, "manifest.json")
    with open(manifest, "w") as f:
        json.dump([{"id": n, "name": n, "date": d, "cloud_cover": 1.0, "path": p} for n, d, _, _, p in tiles], f)
    obs = job.load_observations(spark, manifest, step=10, strip_rows=2)
    out = os.path.join(tmpdir_path, "out")
    res = job.run(spark, obs, out, crop=(0, 870, 0, 1098), stride=1)
    assert set(res.timings) == {"load", "statistics", "cube", "chart_tables"}

    stats = store.read_stats_csv(spark, os.path.join(out, "global_stats"))
    assert stats.count() == 2 and dict(stats.dtypes)["date"] == "date"
    o = store.read_observations(spark, os.path.join(out, "observations"), with_tile=True)
    direct = date_stats(obs.drop("tile_id"))
    a = sorted((str(r.date), round(r.ndvi_mean, 6), r.pixel_count) for r in stats.collect())
    b = sorted((r.date, round(r.ndvi_mean, 6), r.pixel_count) for r in direct.collect())
    assert a == b
    cube, dates = store.read_cube(spark, os.path.join(out, "cube"))
    assert [r.date for r in dates.collect()] == ["2024-01-05", "2024-03-05"]
    assert cube.filter(F.col("value").isNotNull()).count() == o.count()
    one = cube.filter(F.col("t") == 1)
    assert "PartitionFilters: [isnotnull(t" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == cube.count() // 2
    mesh = spark.read.parquet(os.path.join(out, "mesh"))
    assert mesh.filter(F.col("value").isNull()).count() == 0


def test_select_to_manifest(spark, tmpdir_path):
    from rastercube.sources.manifest import read_manifest

    products = [
        {"Id": f"p{i}", "Name": f"S2A_MSIL2A_2024{m:02d}01_T33TTG", "Collection": "SENTINEL-2",
         "ContentDate": {"Start": f"2024-{m:02d}-01T10:00:00.000Z"},
         "Attributes": [{"Name": "productType", "Value": "S2MSI2A"}, {"Name": "cloudCover", "Value": str(c)}]}
        for i, (m, c) in enumerate([(1, 5), (2, 1), (3, 9), (4, 2), (5, 3), (6, 4), (7, 6), (8, 7), (9, 8), (10, 1)])
    ]
    src = os.path.join(tmpdir_path, "products.json")
    with open(src, "w") as f:
        f.write("\n".join(json.dumps(p) for p in products))
    out = os.path.join(tmpdir_path, "manifest")
    chosen = job.select_to_manifest(spark, src, out, "/data/raw/", start_after="2024-01-01", start_before="2024-12-31")
    ids = [r.id for r in chosen.collect()]
    # months 1,3,4,5,6,7,8,9 are the first eight target months present (Feb skipped)
    assert ids == ["p0", "p2", "p3", "p4", "p5", "p6", "p7", "p8"]
    m = read_manifest(spark, out, multi_line=False).orderBy("date").collect()
    assert [r.date for r in m][:2] == ["2024-01-01", "2024-03-01"]


def test_materialize_and_preview(spark, capsys):
    from fixtures import obs_df

    o = store.materialize(obs_df(spark))
    assert o.is_cached and o.count() == 5
    store.preview(o, 2, schema=True)
    out = capsys.readouterr().out
    assert "ndvi" in out and "only showing top 2 rows" in out
    o.unpersist()


def test_store_writes_few_files_per_date(spark, tmpdir_path):
    import glob

    from fixtures import SF01
    from rastercube.sources import testdata as td

    store.write_observations(td.obs(spark, SF01), tmpdir_path)
    folders = glob.glob(os.path.join(tmpdir_path, "date=*"))
    assert len(folders) == 83
    assert max(len(glob.glob(os.path.join(f, "*.parquet"))) for f in folders) <= 2
    back = store.read_observations(spark, tmpdir_path)
    assert back.count() == td.obs(spark, SF01).count()
    assert dict(back.dtypes)["date"] == "string"


def test_pivots_of_more_zones_than_a_table_has_columns(spark, tmpdir_path):
    """More than 10,000 zones: none is left out."""
    n = 10_050
    stats = spark.range(n).select(F.format_string("z%05d", "id").alias("zone"), F.explode(F.array(F.lit("d1"), F.lit("d2"))).alias("date"),
                                  (F.col("id") / 100).alias("ndvi_mean"))
    parts = job.write_pivots(stats, stats, tmpdir_path, most=4_000)
    assert parts == 3
    seen = {}
    for k in range(parts):
        table = spark.read.option("header", True).option("inferSchema", True).csv(f"{tmpdir_path}/part={k}")
        rows = table.collect()
        assert [r.date for r in rows] == ["d1", "d2"]
        seen |= {c: rows[1][c] for c in table.columns if c != "date"}
    assert seen == {f"z{i:05}": i / 100 for i in range(n)}


def test_job_with_an_index_of_compressed_bands(spark, tmpdir_path):
    """A second load indexes nothing again and gives the same rows; pivots are cut where asked."""
    import zipfile

    from test_seekable import _archive, _bands

    for i in range(2):
        _archive(os.path.join(tmpdir_path, f"S2_MSIL2A_2024010{i}_T33TTG.zip"), _bands(600, 500, i), zipfile.ZIP_DEFLATED)
    manifest = os.path.join(tmpdir_path, "manifest.json")
    with open(manifest, "w") as f:
        json.dump([{"id": str(i), "name": f"S2_MSIL2A_2024010{i}_T33TTG", "date": f"2024-01-0{i}", "cloud_cover": 1.0,
                    "path": os.path.join(tmpdir_path, f"S2_MSIL2A_2024010{i}_T33TTG.zip")} for i in range(2)], f)
    index = os.path.join(tmpdir_path, "index")
    rows = lambda df: sorted(map(tuple, df.collect()))
    plain = rows(job.load_observations(spark, manifest))
    for _ in range(2):
        assert rows(job.load_observations(spark, manifest, index=index)) == plain
    points = store.read_index(spark, index)
    assert points.count() == points.select("path", "member", "bit").distinct().count() > 0


def test_only_new_acquisitions_are_loaded(spark, tmpdir_path):
    """A rerun reads no tile (the archives are gone), a new one adds one folder and changes no other file."""
    import glob
    import shutil

    from test_seekable import _archive, _bands

    raw, path = os.path.join(tmpdir_path, "raw"), os.path.join(tmpdir_path, "store")
    manifest = os.path.join(tmpdir_path, "manifest.json")
    os.mkdir(raw)

    def listed(items):
        for i, (date, name) in enumerate(items):
            _archive(os.path.join(raw, f"{name}.zip"), _bands(300, 200, i))
        return [{"id": n, "name": n, "date": d, "cloud_cover": 1.0, "path": os.path.join(raw, f"{n}.zip")} for d, n in items]

    def write(rows):
        with open(manifest, "w") as f:
            json.dump(rows, f)

    def files():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/date=*/tile_id=*/*.parquet")}

    first = listed([("2024-01-05", "a"), ("2024-01-05", "b"), ("2024-02-05", "c")])
    write(first)
    plain = sorted(map(tuple, job.load_observations(spark, manifest).select("tile_id", "date", "row", "col", "ndvi").collect()))
    assert job.load_new(spark, manifest, path) == 3
    before = files()
    shutil.move(raw, raw + "-gone")
    os.mkdir(raw)
    assert job.load_new(spark, manifest, path) == 0 and files() == before
    stored = store.read_observations(spark, path, with_tile=True, clustered=True)
    assert sorted(map(tuple, stored.select("tile_id", "date", "row", "col", "ndvi").collect())) == plain

    write(first + listed([("2024-02-05", "d")]))  # a date that the store has, of another tile
    assert job.load_new(spark, manifest, path) == 1
    after = files()
    assert {f: t for f, t in after.items() if f in before} == before
    assert {os.path.dirname(f) for f in set(after) - set(before)} == {f"{path}/date=2024-02-05/tile_id=d"}
    record = spark.createDataFrame([(os.path.join(raw, "d.zip"), "2024-02-05", "d")], "path string, date string, name string")
    store.append_acquisitions(job._scan(spark, record, None), path)
    again = files()  # written again: one folder replaced by the same rows
    assert {f for f in again if f not in after} and {f: t for f, t in again.items() if f in before} == before
    assert store.read_observations(spark, path, with_tile=True, clustered=True).count() == len(plain) + 30 * 20
