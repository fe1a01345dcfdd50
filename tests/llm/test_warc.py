import gzip
import hashlib
import io
import json
import random
import zlib

import pytest

from rastercube.llm import warc


def page_rows():
    rng = random.Random(2)
    big = "".join(rng.choices("abcdef <p>\r\n", k=5000))
    rows = [(i, f"http://h/{i}", "".join(rng.choices("xyzé\r\n\r\n", k=rng.randint(0, 4000)))) for i in range(30)]
    rows += [(30, "http://h/a", big), (31, None, big), (32, "u\r\nInjected: 1", big), (33, "x", "small"), (34, "y", "small"),
             (35, "z", None), (36, "z", ""), (None, "n", "no id"), (None, "n", big), (32, "again", big), (37, "w", "é" * 499),
             (38, "w", "é" * 499), (39, "w", "é" * 500), (40, "w", "é" * 500)]
    return [(*r, "t", "d", "h") for r in rows]


def test_round_trip(spark, pages_schema, tmp_path):
    rows = page_rows()
    pages = spark.createDataFrame(rows, pages_schema).repartition(3)
    got = warc.round_trip(pages, f"file://{tmp_path}").collect()
    best = {}
    for r in rows:
        h = (r[2] or "").encode()
        if len(h) >= 1000 and r[0] is not None:
            best[h] = max(best.get(h, -1), r[0])
    want = []
    for r in rows:
        h = (r[2] or "").encode()
        other = best.get(h) if best.get(h) != r[0] else None
        want.append((r[0], len(h), hashlib.sha1(h).hexdigest(), "revisit" if other is not None else "response", other))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    files = sorted((tmp_path / "normal").glob("*.warc.gz"))
    assert files and sorted(f.name for f in files) == sorted(f.name for f in (tmp_path / "crawled").glob("*.gz"))
    for f in files:
        data, at = f.read_bytes(), 0
        assert gzip.decompress(data) == gzip.decompress((tmp_path / "crawled" / f.name).read_bytes())
        for line in (tmp_path / "normal" / f"{f.name}.index.jsonl").read_text().splitlines():
            x = json.loads(line)
            assert x["offset"] == at
            one = zlib.decompressobj(31)
            assert one.decompress(data[at: at + x["length"]]).startswith(b"WARC/1.1\r\n") and one.eof and not one.unused_data
            at += x["length"]
        assert at == len(data)


def test_large_partitions_start_new_archives(spark, pages_schema, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 4000)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(warc)
    try:
        pages = spark.createDataFrame(page_rows(), pages_schema).coalesce(1)
        assert warc.round_trip(pages, f"file://{tmp_path}").count() == len(page_rows())
    finally:
        cloudpickle.unregister_pickle_by_value(warc)
    assert len(list((tmp_path / "crawled").glob("*.gz"))) > 3


def test_inflate_takes_any_members_and_refuses_cut_ones():
    data = bytes(range(256)) * 40_000
    packed = gzip.compress(data[:100]) + gzip.compress(b"") + gzip.compress(data)
    assert b"".join(warc.inflate(io.BytesIO(packed))) == data[:100] + data
    with pytest.raises(ValueError):
        list(warc.inflate(io.BytesIO(packed[:-9])))
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))


def test_empty(spark, pages_schema):
    assert warc.round_trip(spark.createDataFrame([], pages_schema)).count() == 0
