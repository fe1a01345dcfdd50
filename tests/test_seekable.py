"""Access points into compressed members, and tiles read through them by many tasks."""

import io
import os
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastercube.sources import seekable, store, tiles


def _archive(path, bands, compression=zipfile.ZIP_DEFLATED, level=None):
    with zipfile.ZipFile(path, "w", compression, compresslevel=level) as zf:
        for band, data in bands.items():
            raw = io.BytesIO()
            np.save(raw, data)
            zf.writestr(f"GRANULE/IMG_DATA/R10m/T00AAA_20240105_{band}_10m.npy", raw.getvalue())


def _bands(h, w, seed, kind=np.uint16, nir=None):
    rng = np.random.default_rng(seed)
    smooth = lambda h, w: (np.add.outer(np.arange(h) * 3, np.arange(w) * 5) % 4000 + rng.integers(0, 500, (h, w))).astype(kind)
    return {"B04": smooth(h, w), "B08": smooth(*(nir or (h, w)))}


@pytest.mark.parametrize("level", [1, 6, 9])
def test_any_part_from_any_point(tmpdir_path, level):
    path = os.path.join(tmpdir_path, "a.zip")
    _archive(path, _bands(1200, 1000, 1), level=level)
    with zipfile.ZipFile(path) as zf:
        member = zf.namelist()[0]
        raw = zf.read(member)
        points = list(seekable.access_points(zf.fp, *seekable.deflated_span(zf, member), every=300_000))
        assert len(points) >= 4
        for point in [None, *points]:
            bit, out, window = point or (0, 0, b"")
            assert window == raw[max(0, out - seekable.WINDOW): out]
            f = seekable.InflatedFile(zf, member, point)
            assert f.read(128) == raw[:128]
            for start in (out, out + 77_777, len(raw) - 5):
                f.seek(start)
                assert f.tell() == start and f.read(90_000) == raw[start:start + 90_000]
            f.seek(10)  # backwards
            assert f.read(100) == raw[10:110]


def test_streams_without_points():
    """Blocks of fixed codes, stored blocks, a single block, an empty stream."""
    data = np.random.default_rng(2).integers(0, 255, 400_000).astype(np.uint8).tobytes()
    for raw, options in ((data, dict(strategy=zlib.Z_FIXED)), (data, dict(level=0)), (b"a" * 500_000, {}), (b"", {})):
        c = zlib.compressobj(wbits=-15, **options)
        packed = c.compress(raw) + c.flush()
        for bit, out, window in seekable.access_points(io.BytesIO(packed), 0, len(packed), every=50_000):
            assert window == raw[max(0, out - seekable.WINDOW): out]


def test_a_cut_archive_is_an_error():
    c = zlib.compressobj(wbits=-15)
    packed = c.compress(os.urandom(200_000)) + c.flush()
    with pytest.raises(EOFError):
        list(seekable.access_points(io.BytesIO(packed[:100_000]), 0, len(packed)))


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_strips_of_compressed_rasters_are_read_by_many_tasks(spark, tmpdir_path):
    paths = []
    for i, (kind, nir, packed) in enumerate([(np.uint16, None, True), (np.uint16, (600, 500), True), (np.float32, None, True),
                                             (np.uint16, None, False)]):
        path = os.path.join(tmpdir_path, f"t{i}.zip")
        _archive(path, _bands(1200, 1000, i, kind, nir), zipfile.ZIP_DEFLATED if packed else zipfile.ZIP_STORED)
        paths.append((path, f"2024-0{i + 1}-05"))
    records = spark.createDataFrame(paths, "path string, date string")
    index = os.path.join(tmpdir_path, "index")
    store.write_index(tiles.index_tiles(spark, records, every=300_000), index)
    points = store.read_index(spark, index)
    assert points.select("path").distinct().count() == 3 and points.where("out > 0").count() >= 12
    plain = tiles.load_tiles(spark, records, strip_rows=10)
    pointed = tiles.load_tiles(spark, records, strip_rows=10, points=points)
    assert _rows(pointed) == _rows(plain)
    part = pointed.where(F.col("date") == "2024-01-05").withColumn("task", F.spark_partition_id())
    assert part.select("task").distinct().count() == 8  # one raster, all tasks
    assert plain.where(F.col("date") == "2024-01-05").select(F.spark_partition_id()).distinct().count() == 1
    some = tiles.load_tiles(spark, records, strip_rows=10, points=points, rows=(500, 690))
    assert _rows(some) == _rows(plain.where("row between 500 and 690"))


def test_index_is_kept_up(spark, tmpdir_path):
    """Only new and changed archives are indexed again; points of a changed archive are not used."""
    a, b = (os.path.join(tmpdir_path, f"{x}.zip") for x in "ab")
    _archive(a, _bands(600, 500, 1))
    _archive(b, _bands(600, 500, 2))
    both = spark.createDataFrame([(a, "2024-01-05"), (b, "2024-02-05")], "path string, date string")
    known = spark.createDataFrame(tiles.index_tiles(spark, both.limit(1), every=100_000).collect(), tiles.INDEX_DDL)
    new = tiles.index_tiles(spark, both, every=100_000, known=known)
    assert {r.path for r in new.select("path").collect()} == {b}
    _archive(a, _bands(600, 500, 3))
    assert {r.path for r in tiles.index_tiles(spark, both, every=100_000, known=known).select("path").collect()} == {a, b}
    got = tiles.load_tiles(spark, both, strip_rows=10, points=known)
    assert _rows(got) == _rows(tiles.load_tiles(spark, both, strip_rows=10))
