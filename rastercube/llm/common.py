"""Helpers shared by the operators: settled tables, size-checked joins, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.session import checkpoint_dir

# A side is broadcast only when it was counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 100_000
# The same for a side with strings of any length, by bytes.
BROADCAST_BYTES = 32 << 20
# Code points that separate words, in every contract: space and \x09-\x0D.
WHITE = b" \t\n\x0b\x0c\r"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    This cuts the lineage at a table that outlives any executor.  The folder
    is the one ``spark.checkpoint.dir`` names; its tables are as temporary as
    other checkpoints there.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` rows, else as it is (a shuffled join then)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def checked_bytes(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcasting if its strings and fixed columns (16 bytes each) have at most ``most`` bytes in all."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size += F.coalesce(F.octet_length(name), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most else df


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def byte_values(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8192) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of the ``(u, v)`` edges: the smallest node that it reaches.

    Alternates the large-star and small-star steps, each one aggregation of a
    minimum (combined map-side) and one join back, until the edges stay as
    they are; then every edge leads from a node to its root.  Each step's
    edges are settled, and so are the minima: AQE splits a skewed join only
    where both its sides come straight from a shuffle, not from an
    aggregation.  So no group is gathered, and a node with very many edges
    only makes a join that is split.  An empty edge table gives none.
    """
    edges = settle(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        # large star: each larger neighbour of a node is tied to the smallest one
        both = edges.union(edges.select("v", "u")).toDF("a", "b")
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u != v").distinct())
        # small star: a node and its smaller neighbours are tied to the smallest
        least = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u")
        edges = settle(small.select("u", F.col("m").alias("v")).union(
            small.where("v != m").select("v", "m")).distinct())
        after = _state(edges)
        if after == state:
            break
        state = after
    return edges.toDF("node", "root").union(edges.select("v", "v").distinct().toDF("node", "root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)),
                           F.coalesce(F.sum(F.hash("u", "v").cast("long")), F.lit(0))).first())


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
