"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, checked_bytes, mix64, settle

MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 1024, 4096, 32768
_GEAR = mix64(np.arange(256, dtype=np.uint64)).astype(np.uint32)


def chunk_ends(text: bytes) -> list[int]:
    """Ends of the chunks of ``text``: where a rolling hash of the last 32 bytes hits, within the size limits."""
    n = len(text)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(text, np.uint8)]
    for s in (1, 2, 4, 8, 16):  # h[i] = sum of gear[b[i - k]] << k, by doubling
        h[s:] = h[s:] + (h[:-s] << np.uint32(s))
    ends, last = [], 0
    for hit in (np.flatnonzero(h >> np.uint32(20) == 0) + 1).tolist() + [n]:
        while hit - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if hit - last >= MIN_CHUNK or hit == n > last:
            ends.append(hit)
            last = hit
    return ends


def chunks(text: bytes) -> list[bytes]:
    ends = chunk_ends(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def chunk_id(chunk: bytes, seed: int) -> bytes:
    """A chunk's identifier; :func:`recipes` verifies that no two contents share one, else takes another seed."""
    return xxhash.xxh3_128_digest(chunk, seed)


def _recipes(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in byte_values(batch.column(2))]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1),
            pa.array([b"".join(chunk_id(c, seed) for c in chunks(t)) for t in texts], pa.binary()),
            pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
            names=["row", "doc_id", "recipe", "text_sha256"])


def _chunks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            found = {}
            for t in byte_values(batch.column(0).slice(at, 1024)):
                for c in chunks(t or b""):
                    found[c] = chunk_id(c, seed)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found.values()), pa.binary()), pa.array(list(found), pa.binary())],
                    names=["id", "chunk"])


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, recipe, text_sha256)``: each text as the list of its chunks' verified identifiers.

    Every chunk's bytes are moved once, to where chunks of its identifier meet
    (repeats within a task were combined before), and compared there.  If two
    contents share an identifier, all is done again with another seed; so
    equal recipes are equal texts without reliance on a digest.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    for seed in range(64):
        met = texts.select("text").mapInArrow(lambda b, s=seed: _chunks(b, s), "id binary, chunk binary")
        met = met.groupBy("id").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
        if not met.where("least != most").limit(1).count():
            return settle(texts.mapInArrow(
                lambda b, s=seed: _recipes(b, s), "row long, doc_id long, recipe binary, text_sha256 string"))
    raise RuntimeError("no seed gives chunks distinct identifiers")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty.  The row of the
    largest doc_id stays (a null id counts as the smallest; of repeated rows
    with that id one stays, the others are dropped).  An empty table gives
    none; other columns are left out.  The groups' recipes are broadcast only
    if they have few bytes in all, else joined by a shuffle.
    """
    made = recipes(docs, id_col, text_col)
    best = F.max(F.struct("doc_id", "row")).alias("best")
    groups = settle(made.groupBy("recipe").agg(best, F.count("*").alias("n")).where("n > 1"))
    return made.join(checked_bytes(groups), "recipe", "left").select(
        "doc_id", F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.row") == F.col("row"), F.lit(True)).alias("kept"), "text_sha256")
