"""Many zones at once, from blocks of pixels, against the join of pixels and zones."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fixtures import SF001
from rastercube.operators import zone_blocks, zones
from rastercube.plans.queries import customer_boxes
from rastercube.sources import testdata as td

OBS = "tile_id string, date string, row int, col int, ndvi float"
BOXES = "zone string, tile_id string, row_min int, row_max int, col_min int, col_max int"


def stats(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def odd_rows(spark):
    """Missing values, repeated pixels, null keys; boxes of all sizes, repeated, inverted, of one name in several tiles."""
    rng = random.Random(5)
    obs = [(rng.choice(("A", "B", None)), rng.choice(("d1", "d2", None)), rng.randrange(0, 90) * 3, rng.randrange(-20, 300),
            rng.choice((None, float("nan"), 0.5, rng.random(), rng.random(), rng.random()))) for _ in range(3000)]
    obs += obs[:300] + [("A", "d3", 0, 0, None), ("A", "d3", 0, 1, None)]
    boxes = []
    for i in range(150):
        r, c, h, w = rng.randrange(-30, 280), rng.randrange(-30, 280), rng.choice((0, 2, 9, 40, 400)), rng.choice((0, 5, 33, 64))
        boxes.append((f"z{i % 110}", rng.choice(("A", "B", None)), r, r + h, c, c + w))
    boxes += boxes[:5] + [(None, "A", 0, 50, 0, 50), (None, "A", 10, 20, 10, 90), ("turned", "A", 50, 0, 0, 50),
                          ("empty", "B", 5000, 6000, 0, 9), ("unset", "A", None, 3, 0, 9)]
    return spark.createDataFrame(obs, OBS), spark.createDataFrame(boxes, BOXES)


def both(obs, boxes, by=None):
    return stats(zones.zone_stats(obs, boxes, strategy="blocks", by=by)), stats(zones.zone_stats(obs, boxes, strategy="cells", by=by))


def test_customer_boxes(spark):
    """as many zones as customers."""
    got, want = both(td.obs(spark, SF001), customer_boxes(spark, SF001))
    assert got == want and len(got) > 100


@pytest.mark.parametrize("by_tile", [True, False])
def test_odd_rows(spark, by_tile):
    obs, boxes = odd_rows(spark)
    got, want = both(obs, boxes, ["tile_id"] if by_tile else None)
    assert got == want and any(r[-1] == 0 for r in got)
    untiled = boxes.drop("tile_id")
    got, want = both(obs, untiled, ["tile_id"] if by_tile else None)
    assert got == want


@pytest.mark.parametrize("name, value", [("MAX_PIXELS", 200), ("MAX_PARTS", 1), ("CHUNK_BOXES", 2), ("MAX_BROADCAST_BOXES", 0),
                                         ("MAX_BROADCAST_BLOCKS", 0), ("GATHERED", 50)])
def test_limits_change_nothing(spark, monkeypatch, name, value):
    """Past a limit the work goes another way, with the same rows."""
    obs, boxes = odd_rows(spark)
    want = stats(zones.zone_stats(obs, boxes, strategy="cells"))
    monkeypatch.setattr(zone_blocks, name, value)
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(zone_blocks)
    try:
        assert stats(zones.zone_stats(obs, boxes, strategy="blocks")) == want
    finally:
        cloudpickle.unregister_pickle_by_value(zone_blocks)


def test_many_zones_go_by_blocks(spark, monkeypatch):
    """more zones than are told apart inline are not joined with every pixel."""
    called = []
    real = zones.block_measures
    monkeypatch.setattr(zones, "block_measures", lambda *a, **k: called.append(1) or real(*a, **k))
    boxes = td.test_boxes(spark)
    zones.zone_stats(td.obs(spark, SF001), boxes)
    assert not called
    zones.zone_stats(td.obs(spark, SF001), boxes, max_inline=3)
    assert called


def test_no_boxes_or_pixels(spark):
    obs, boxes = odd_rows(spark)
    for o, b in ((obs.limit(0), boxes), (obs, boxes.limit(0))):
        empty = zones.zone_stats(o, b, strategy="blocks", by=["tile_id"])
        assert empty.collect() == []
        assert empty.columns == ["tile_id", "zone", "date", "ndvi_mean", "ndvi_std", "ndvi_p25", "ndvi_p75", "pixel_count"]


def test_zones_by_tile(spark):
    """zones of the same name are apart in each tile."""
    o = spark.createDataFrame([("T0", "d", 0, 0, 0.1), ("T0", "d", 0, 9, 0.2), ("T1", "d", 0, 0, 0.4)], OBS)
    b = spark.createDataFrame([("z", "T0", 0, 0, 0, 9), ("z", "T1", 0, 0, 0, 0)], BOXES)
    rows = stats(zones.zone_stats(o, b, strategy="blocks", by=["tile_id"]).select("tile_id", "zone", "date", "ndvi_mean", "pixel_count"))
    assert [(r[0], round(r[3], 6), r[4]) for r in rows] == [("T0", 0.15, 2), ("T1", 0.4, 1)]


def test_zone_in_several_tiles(spark):
    """a zone's pixels in all its tiles are measured together."""
    four = [("T0", "d", 0, 0, 0.1), ("T0", "d", 0, 9, 0.2), ("T1", "d", 0, 0, 0.4), ("T1", "d", 1, 0, 0.9)]
    o = spark.createDataFrame(four, OBS)
    b = spark.createDataFrame([("z", "T0", 0, 0, 0, 9), ("z", "T1", 0, 0, 0, 0), ("y", "T1", 0, 9, 0, 0)], BOXES)
    rows = {r.zone: r for r in zones.zone_stats(o, b, strategy="blocks").collect()}
    assert rows["z"].pixel_count == 3 and rows["z"].ndvi_p25 == pytest.approx(0.15) and rows["z"].ndvi_p75 == pytest.approx(0.3)
    assert rows["y"].ndvi_mean == pytest.approx(0.65)


def test_zones_in_several_tiles_write_little(spark, monkeypatch):
    """no row for each zone and date, and no values for each box, lies on disk."""
    o = [(t, f"d{d}", r, c, float(r * c + d)) for t in "AB" for d in range(30) for r in range(8) for c in range(8)]
    b = [(f"z{i}", t, 0, 3, *cols) for i in range(80) for t, cols in (("A", (4 + i % 2, 7)), ("B", (0, 2)))]
    written = []
    real = zone_blocks._written
    monkeypatch.setattr(zone_blocks, "_written", lambda df: written.append(real(df)) or written[-1])
    got, want = both(spark.createDataFrame(o, OBS), spark.createDataFrame(b, BOXES))
    assert got == want and len(got) == 80 * 30
    assert sum(df.count() for df in written) < 80 * 30 and not any("values" in df.columns for df in written)


@pytest.mark.parametrize("worth", [0, 1e9])
def test_ways_of_zones_in_several_blocks_agree(spark, monkeypatch, worth):
    """the pixels of all their blocks together, or the values of their boxes."""
    obs, boxes = odd_rows(spark)
    monkeypatch.setattr(zone_blocks, "WORTH", worth)
    got, want = both(obs, boxes)
    assert got == want


def test_zones_are_in_order(spark):
    obs, boxes = odd_rows(spark)
    for by in (["tile_id"], []):
        for b in (boxes, boxes.drop("tile_id")):
            rows = [tuple(r) for r in zones.zone_stats(obs, b, strategy="blocks", by=by).select(*by, "zone", "date").collect()]
            assert rows == sorted(rows, key=lambda r: [(x is not None, x or "") for x in r])


@pytest.mark.parametrize("kind", [pa.float32(), pa.float64()])
def test_zones_of_parts_are_measured_together(monkeypatch, kind):
    """many zones at once, and not a batch for each; whatever the values."""
    rng = random.Random(2)
    odd = [-1.5, -0.0, 0.0, 2e-40, float("inf"), float("-inf"), float("nan"), -float("nan"), 0.25, -0.75, 1e30]
    rows = [[[rng.choice(odd[:4] + odd[6:]) for _ in range(rng.randrange(1, 9))] for _ in range(rng.randrange(1, 5))] for _ in range(300)]
    rows[7] = [[float("nan")], [float("nan")]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(rows, pa.list_(pa.list_(kind)))], names=["parts", "all"])
    got = list(zone_blocks._measure_parts([batch.slice(0, 3), batch.slice(3)]))
    assert len(got) == 2
    monkeypatch.setattr(zone_blocks, "GATHERED", 20)
    assert pa.Table.from_batches(zone_blocks._measure_parts([batch])).num_rows == 300
    for (i, p25, p75, n), row in zip(((r["parts"], r["p25"], r["p75"], r["n"]) for b in got for r in b.to_pylist()), rows):
        flat = np.array([x for y in row for x in y], kind.to_pandas_dtype()).astype(float)
        flat = flat[~np.isnan(flat)]
        assert n == len(flat) and rows[i] is row
        assert (p25, p75) == ((None, None) if not n else tuple(np.quantile(flat, (0.25, 0.75)).tolist())) or np.allclose(
            (p25, p75), np.quantile(flat, (0.25, 0.75)))
