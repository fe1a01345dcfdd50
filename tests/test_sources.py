import io
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastercube.functions.paths import resolve_path
from rastercube.schema import ARCHIVE_LISTING
from rastercube.sources.archives import archive_completeness, list_archives, resolve_bands
from rastercube.sources.manifest import read_manifest, tile_records, write_manifest
from rastercube.sources.tiles import NpyBand, find_band, load_tiles, onto_grid


def test_path_mapping(spark):
    paths = [
        ("C:\\data\\raw\\a.zip",),
        ("d:/x\\y/b.zip",),
        ("/mnt/c/raw/c.zip",),
        ("plain.zip",),
        ("C:relative.zip",),
    ]
    df = spark.createDataFrame(paths, "path string")
    got = df.select(resolve_path("path").alias("l"), resolve_path("path", "/data/raw").alias("p")).collect()
    assert [r.l for r in got] == ["/mnt/c/data/raw/a.zip", "/mnt/d/x/y/b.zip", "/mnt/c/raw/c.zip", "plain.zip", "C:relative.zip"]
    assert [r.p for r in got] == ["/data/raw/a.zip", "/data/raw/b.zip", "/data/raw/c.zip", "/data/raw/plain.zip", "/data/raw/relative.zip"]


LISTINGS = {
    # strict match listed after a loose one: strict wins
    "both": ["G/IMG_DATA/R20m/T_B04_20m.jp2", "G/IMG_DATA/R10m/T_B04_10m.jp2", "G/IMG_DATA/R10m/T_B08_10m.jp2"],
    # only a loose match (coarser resolution)
    "loose": ["G/IMG_DATA/R60m/T_B04_60m.jp2", "G/IMG_DATA/R20m/T_B08_20m.jp2"],
    # several strict: first in listing order
    "several": ["A/IMG_DATA/R10m/x_B04_10m.jp2", "B/IMG_DATA/R10m/y_B04_10m.jp2", "B/IMG_DATA/R10m/y_B08_10m.jp2"],
    # none
    "none": ["MTD.xml", "QI/MSK_B04_x.gml"],
}


def _listing_df(spark):
    rows = [(a, i, m, True) for a, ms in LISTINGS.items() for i, m in enumerate(ms)]
    return spark.createDataFrame(rows, ARCHIVE_LISTING)


def test_band_resolution_rules(spark):
    got = {(r.archive, r.band): r.member for r in resolve_bands(_listing_df(spark), ["B04", "B08"], "null").collect()}
    assert got[("both", "B04")] == "G/IMG_DATA/R10m/T_B04_10m.jp2"
    assert got[("loose", "B04")] == "G/IMG_DATA/R60m/T_B04_60m.jp2"
    assert got[("loose", "B08")] == "G/IMG_DATA/R20m/T_B08_20m.jp2"
    assert got[("several", "B04")] == "A/IMG_DATA/R10m/x_B04_10m.jp2"
    assert got[("none", "B04")] is None
    for a, ms in LISTINGS.items():
        for b in ["B04", "B08"]:
            try:
                want = find_band(ms, b)
            except FileNotFoundError:
                want = None
            assert got[(a, b)] == want


def test_band_resolution_missing_is_error(spark):
    with pytest.raises(Exception, match="not found"):
        resolve_bands(_listing_df(spark), ["B04"], "error").collect()


def _write_tile(folder, name, red, nir, extra=()):
    path = os.path.join(folder, f"{name}.zip")
    with zipfile.ZipFile(path, "w") as zf:
        for member in extra:
            zf.writestr(member, b"x")
        for band, arr in (("B04", red), ("B08", nir)):
            buf = io.BytesIO()
            np.save(buf, arr)
            zf.writestr(f"{name}.SAFE/GRANULE/L2A/IMG_DATA/R10m/T33TTG_{name}_{band}_10m.npy", buf.getvalue())
    return path


def _tiles(folder):
    rng = np.random.default_rng(1)
    tiles = []
    for i, date in enumerate(["2024-01-05", "2024-03-05"]):
        red = rng.integers(0, 3000, size=(60, 50)).astype(np.uint16)
        nir = rng.integers(0, 5000, size=(60, 50)).astype(np.uint16)
        red[:10, :10] = 0  # a no-data block
        tiles.append((f"tile{i}", date, red, nir, _write_tile(folder, f"tile{i}", red, nir, extra=["MTD.xml"])))
    return tiles


def _expected(tiles, step):
    out = []
    for name, date, red, nir, _ in tiles:
        h, w = red.shape[0] // step, red.shape[1] // step
        r = np.floor(red[: h * step, : w * step].reshape(h, step, w, step).astype(float).mean(axis=(1, 3)) + 0.5).astype(np.float32)
        n = np.floor(nir[: h * step, : w * step].reshape(h, step, w, step).astype(float).mean(axis=(1, 3)) + 0.5).astype(np.float32)
        for i in range(h):
            for j in range(w):
                if r[i, j] > 0 and n[i, j] > 0:
                    nd = np.float32((n[i, j] - r[i, j]) / (n[i, j] + r[i, j]))
                    out.append((name, date, i * step, j * step, float(r[i, j]), float(n[i, j]), float(nd)))
    return sorted(out)


def test_tile_source_matches_numpy(spark, tmpdir_path):
    tiles = _tiles(tmpdir_path)
    recs = spark.createDataFrame([(p, d, n) for n, d, _, _, p in tiles], "path string, date string, name string")
    df = load_tiles(spark, recs, step=10, strip_rows=2)
    got = sorted(tuple(r) for r in df.collect())
    assert got == _expected(tiles, 10)
    assert df.filter(F.col("red") <= 0).count() == 0


def test_tile_source_reads_only_chosen_strips(spark, tmpdir_path):
    tiles = _tiles(tmpdir_path)
    recs = spark.createDataFrame([(p, d, n) for n, d, _, _, p in tiles], "path string, date string, name string")
    q = load_tiles(spark, recs.filter("date = '2024-03-05'"), step=10, strip_rows=2, rows=(30, 45))
    want = [t for t in _expected(tiles, 10) if t[1] == "2024-03-05" and 30 <= t[2] <= 45]
    assert sorted(tuple(r) for r in q.collect()) == want


def test_tile_height_comes_from_the_raster(spark, tmpdir_path):
    red = np.full((12000, 20), 100, np.uint16)
    path = _write_tile(tmpdir_path, "tall", red, red)
    recs = spark.createDataFrame([(path, "2024-01-05", "tall")], "path string, date string, name string")
    got = load_tiles(spark, recs).agg(F.count("*"), F.max("row")).first()
    assert tuple(got) == (2400, 11990)


def test_second_band_is_averaged_onto_the_first(spark, tmpdir_path):
    red = np.full((60, 60), 100, np.uint16)
    fine = np.full((120, 120), 100, np.uint16)
    fine[:, :90] = 300
    coarse = np.full((30, 30), 100, np.uint16)
    coarse[:, :20] = 300
    rows = [(_write_tile(tmpdir_path, n, red, nir), "2024-01-05", n) for n, nir in (("fine", fine), ("coarse", coarse))]
    got = load_tiles(spark, spark.createDataFrame(rows, "path string, date string, name string"), strip_rows=2).collect()
    half = {n: sum(r.ndvi == 0.5 for r in got if r.tile_id == n) for n in ("fine", "coarse")}
    assert len(got) == 72 and half == {"fine": 24, "coarse": 24}
    assert {round(r.ndvi, 4) for r in got if r.tile_id == "fine"} == {0.5, 0.3333, 0.0}  # the column of cells cut in half
    quarters = fine.copy()
    quarters[60:, 60:], quarters[:60], quarters[60:, :60] = 100, 300, 300
    path = _write_tile(tmpdir_path, "quarters", red, quarters)
    got = load_tiles(spark, spark.createDataFrame([(path, "d", "q")], "path string, date string, name string")).collect()
    assert sum(r.ndvi == 0.5 for r in got) == 27 and sum(r.ndvi == 0.0 for r in got) == 9
    odd = onto_grid(np.arange(49, dtype=np.float64).reshape(7, 7), np.linspace(0, 7, 4), np.linspace(0, 7, 4))
    fine_grid = np.repeat(np.repeat(np.arange(49.0).reshape(7, 7), 3, 0), 3, 1).reshape(3, 7, 3, 7).mean(axis=(1, 3))
    assert np.allclose(odd, fine_grid)


def test_truncated_manifest_is_an_error(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "cut.json")
    with open(p, "w") as f:
        f.write('[{"id": "a", "name": "n", "date": "2024-01-05", "path": "x.zip"}, {"id": "b", "na')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_manifest(spark, p).collect()


def test_archive_listing_and_completeness(spark, tmpdir_path):
    tiles = _tiles(tmpdir_path)
    bad = os.path.join(tmpdir_path, "broken.zip")
    with open(bad, "wb") as f:
        f.write(b"not a zip")
    empty = os.path.join(tmpdir_path, "empty.zip")
    zipfile.ZipFile(empty, "w").close()
    paths = spark.createDataFrame([(t[4],) for t in tiles] + [(bad,), (empty,)], "path string")
    lst = list_archives(paths)
    comp = {os.path.basename(r.archive): r.complete for r in archive_completeness(lst).collect()}
    assert comp == {"tile0.zip": True, "tile1.zip": True, "broken.zip": False, "empty.zip": False}
    res = resolve_bands(lst.filter(F.col("member").isNotNull()), ["B04", "B08"], "error", ext=".npy").collect()
    assert all(r.member.endswith(f"_{r.band}_10m.npy") for r in res)


def test_manifest_roundtrip(spark, tmpdir_path):
    doc = [
        {"id": "a", "name": "S2A_x", "date": "2024-01-05", "cloud_cover": 3.5, "path": "C:\\raw\\S2A_x.zip"},
        {"id": "b", "name": "S2B_y", "date": "2024-03-05", "cloud_cover": 50.0, "path": "/mnt/c/raw/S2B_y.zip"},
    ]
    p = os.path.join(tmpdir_path, "manifest.json")
    with open(p, "w") as f:
        json.dump(doc, f, indent=2)
    m = read_manifest(spark, p)
    assert m.count() == 2
    recs = {r.date: r.path for r in tile_records(m, "/data/raw").collect()}
    assert recs == {"2024-01-05": "/data/raw/S2A_x.zip", "2024-03-05": "/data/raw/S2B_y.zip"}
    out = os.path.join(tmpdir_path, "manifest_out")
    write_manifest(m, out)
    back = read_manifest(spark, out, multi_line=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))
    with pytest.raises(Exception):
        read_manifest(spark, os.path.join(tmpdir_path, "missing.json")).count()


def test_tile_source_scale_offset_matches_dataframe_path(spark, tmpdir_path):
    from rastercube.operators.bands import with_ndvi

    tiles = _tiles(tmpdir_path)
    recs = spark.createDataFrame([(p, d, n) for n, d, _, _, p in tiles], "path string, date string, name string")
    raw = load_tiles(spark, recs, step=10, strip_rows=3)
    scaled = load_tiles(spark, recs, step=10, strip_rows=3, scale=0.0001, offset=-0.2)
    via_df = with_ndvi(raw.drop("ndvi"), scale=0.0001, offset=-0.2)
    key = ["tile_id", "date", "row", "col"]
    a = {tuple(r[k] for k in key): r.ndvi for r in scaled.collect()}
    b = {tuple(r[k] for k in key): r.ndvi for r in via_df.collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        if b[k] is None:
            assert a[k] is None
        else:
            assert a[k] == pytest.approx(b[k], abs=1e-6)
    assert any(v is None for v in a.values())  # zero reflectance sums become NULL


def test_tile_decoder_by_import_path_and_missing_codec(spark, tmpdir_path):
    tiles = _tiles(tmpdir_path)
    recs = spark.createDataFrame([(p, d, n) for n, d, _, _, p in tiles], "path string, date string, name string")
    df = load_tiles(spark, recs, step=10, strip_rows=6, decoder="rastercube.sources.tiles:NPY_DECODER")
    assert sorted(tuple(r) for r in df.collect()) == _expected(tiles, 10)
    with pytest.raises(Exception, match="JPEG-2000"):
        load_tiles(spark, recs, step=10, decoder="jp2").collect()


@pytest.mark.parametrize("scale", [(1, 1), (2, 2), (2, 3)])
def test_compressed_members_give_the_same_rows(spark, tmpdir_path, scale):
    """Stored and compressed archives, bands of unequal resolution, all rows and chosen ones."""
    rng = np.random.default_rng(6)
    red = rng.integers(0, 3000, (250, 60)).astype(np.uint16)
    nir = rng.integers(0, 3000, (250 * scale[0] // scale[1] * 2, 90)).astype(np.uint16)
    recs = []
    for kind in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        path = os.path.join(tmpdir_path, f"kind{kind}-{scale[0]}{scale[1]}.zip")
        with zipfile.ZipFile(path, "w", kind) as zf:
            for band, a in (("B04", red), ("B08", nir)):
                data = io.BytesIO()
                np.save(data, a)
                zf.writestr(f"G/IMG_DATA/R10m/T_{band}_10m.npy", data.getvalue())
        recs.append((path, "2024-03-05"))
    for rows in ((None, None), (35, 144), (140, None), (900, None)):
        stored, packed = (
            sorted(tuple(r)[2:] for r in load_tiles(
                spark, spark.createDataFrame([r], "path string, date string"), strip_rows=3, rows=rows).collect())
            for r in recs)
        assert stored == packed
        assert bool(stored) == (rows[0] != 900)


def test_a_band_read_from_top_to_bottom_never_goes_back(tmpdir_path):
    a = np.arange(4000, dtype=np.uint16).reshape(200, 20)
    path = os.path.join(tmpdir_path, "band.zip")
    data = io.BytesIO()
    np.save(data, a)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("b.npy", data.getvalue())
    with zipfile.ZipFile(path) as zf:
        band = NpyBand(zf, "b.npy")
        sought, seek = [], band.file.seek
        band.file.seek = lambda to: sought.append((to, band.file.tell())) or seek(to)
        for r0, r1 in ((0, 11), (10, 30), (29, 30), (29, 60), (60, 90), (100, 300), (150, 200), (200, 210)):
            assert np.array_equal(band.rows(r0, r1), a[r0:r1])
        assert all(to >= at for to, at in sought)
        assert np.array_equal(band.rows(5, 9), a[5:9])
        band.close()
