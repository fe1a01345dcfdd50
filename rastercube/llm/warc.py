"""WARC archives: writing, normalising monolithic gzip files record by record, reading by offset."""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, checked, record_batches, settle, shuffle_partitions
from rastercube.session import checkpoint_dir

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Bytes of payload after which a task starts another archive, bytes read at a time.
ARCHIVE_BYTES, BLOCK = 256 << 20, 1 << 20
FILES = "archive string, records long"
INDEX = "archive string, offset long, length long, record_id string, record_type string"
READ = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "url string, archive string, offset long")


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://"))


@contextmanager
def _whole(uri: str):
    """A stream whose file appears under its name only when complete, so a repeated task replaces it."""
    fs, path = _open(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part, compression=None) as out:
        yield out
    fs.move(part, path)


def http_head(url: str, length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header and leaves the payload to the record that it names."""
    head = http_head(url or "", len(payload))
    block = head + (payload if kind == "response" else b"")
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{_name(page_id)}>"),
              ("WARC-Date", "2000-01-01T00:00:00Z"),
              ("WARC-Target-URI", " ".join((url or "").split()) or "urn:none"), ("WARC-Payload-Digest", f"sha1:{sha1}")]
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", f"<urn:page:{_name(refers_to)}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return "".join(["WARC/1.1\r\n", *[f"{k}: {v}\r\n" for k, v in fields], "\r\n"]).encode() + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return "null" if page_id is None else str(page_id)


def _number(name: str | None) -> int | None:
    value = (name or "").strip("<>").rpartition(":")[2]
    return None if value in ("", "null") else int(value)


def decisions(pages: DataFrame, least: int = 1000, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The rows of ``pages`` as (page_id, url, payload, digest, original): ``original`` is the page to refer to, or null.

    Equal payloads are those of equal SHA-1 and length.  Groups are combined
    before the shuffle to a digest and its largest page_id; only digests found
    twice are joined back, broadcast if their counted number is small.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("payload"), F.sha1(html.cast("binary")).alias("digest"),
                        F.octet_length(html).alias("n_bytes"))
    groups = settle(rows.where(F.col("n_bytes") >= least).groupBy("digest", "n_bytes").agg(
        F.max("page_id").alias("original"), F.count("*").alias("n")).where("n > 1").drop("n"))
    return rows.join(checked(groups), ["digest", "n_bytes"], "left").select(
        "page_id", "url", "payload", "digest", "original")


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """Write each partition's records as one gzip stream a file (the way many crawlers do); returns the files.

    A row is a revisit if it has an original other than itself.  A large
    partition starts a new file after ``ARCHIVE_BYTES`` of payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(
            b.column(0).to_pylist(), b.column(1).to_pylist(), byte_values(b.column(2)),
            b.column(3).to_pylist(), b.column(4).to_pylist()))
        part, at, row = TaskContext.get().partitionId(), 0, next(rows, None)
        while row is not None:
            uri, n, size = f"{folder}/part-{part:05d}-{at:04d}.warc.gz", 0, 0
            with _whole(uri) as out:
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                while row is not None and size < ARCHIVE_BYTES:
                    page_id, url, payload, digest, original = row
                    revisit = original is not None and original != page_id
                    out.write(packer.compress(record(
                        "revisit" if revisit else "response", page_id, url, payload, digest,
                        original if revisit else None)))
                    n, size, row = n + 1, size + len(payload), next(rows, None)
                out.write(packer.flush())
            at += 1
            yield pa.RecordBatch.from_pydict({"archive": [uri], "records": [n]})

    return decided.mapInArrow(run, FILES)


def inflate(source: io.BufferedIOBase) -> Iterator[bytes]:
    """The content of a gzip file of any number of members, a block at a time."""
    inflater, fed = zlib.decompressobj(31), False
    while block := source.read(BLOCK):
        while block:
            if inflater.eof:
                inflater, fed = zlib.decompressobj(31), False
            fed = True
            data = inflater.decompress(block, 4 * BLOCK)
            block = inflater.unconsumed_tail or (inflater.unused_data if inflater.eof else b"")
            if data:
                yield data
    if fed and not inflater.eof:
        raise ValueError("the gzip stream ends early")


def split_records(blocks: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """``(fields, record)`` of each record, taking the stream apart by Content-Length."""
    held = bytearray()
    for data in blocks:
        held += data
        while True:
            end = held.find(b"\r\n\r\n")
            if end < 0:
                break
            fields = parse_fields(bytes(held[:end]))
            size = end + 4 + int(fields["content-length"]) + 4
            if len(held) < size:
                break
            yield fields, bytes(held[:size])
            del held[:size]
    if held:
        raise ValueError("the archive ends within a record")


def parse_fields(head: bytes) -> dict:
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record where one should start")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives with a gzip member of its own for every record; returns the index rows.

    Each file is inflated once, a block at a time, and deflated record by
    record into ``folder``; the sidecar ``<name>.index.jsonl`` lists record,
    type, offset and length of every member.  A task holds a block and a
    record, so archives may be of any size.  One file is one task: a single
    gzip stream can only be read from its start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("record_id", pa.string()), ("record_type", pa.string())])
        for uri in (u for b in batches for u in b.column(0).to_pylist()):
            target = f"{folder}/{uri.rpartition('/')[2]}"
            fs, path = _open(uri)

            def members() -> Iterator[tuple]:
                offset = 0
                with fs.open_input_stream(path, compression=None) as source, _whole(target) as out, \
                        _whole(f"{target}.index.jsonl") as side:
                    for fields, data in split_records(inflate(source)):
                        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = packer.compress(data) + packer.flush()
                        out.write(member)
                        row = (target, offset, len(member), fields["warc-record-id"], fields["warc-type"])
                        side.write(json.dumps(dict(zip(("offset", "length", "id", "type"), row[1:]))).encode() + b"\n")
                        offset += len(member)
                        yield row

            yield from record_batches(members(), schema)

    return files.select("archive").repartition(shuffle_partitions(files), "archive").mapInArrow(run, INDEX)


def read_records(index: DataFrame) -> DataFrame:
    """Read every indexed record by offset and check it; a response's payload must have the digest in its header."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64())
                            for c in READ.split(", ")])

        def rows() -> Iterator[tuple]:
            opened = None, None
            for batch in batches:
                for uri, offset, length in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                    if opened[0] != uri:
                        fs, path = _open(uri)
                        opened = uri, fs.open_input_file(path)
                    data = zlib.decompress(opened[1].read_at(length, offset), 31)
                    fields, _, block = data.partition(b"\r\n\r\n")
                    fields = parse_fields(fields)
                    head, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
                    size = next(int(x[15:]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
                    kind = fields["warc-type"]
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{uri} at {offset}: the payload is not the one that was written")
                    yield (_number(fields["warc-record-id"]), size, digest, kind, _number(fields.get("warc-refers-to")),
                           fields["warc-target-uri"], uri, offset)

        yield from record_batches(rows(), schema)

    return index.select("archive", "offset", "length").mapInArrow(run, READ)


def round_trip(pages: DataFrame, folder: str | None = None, least: int = 1000) -> DataFrame:
    """Archive ``pages`` in ``folder``, normalise the archives and read every record back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, archive and offset.  Null html is an empty payload, a null url is
    written as urn:none, a null page_id as null (it is the smallest id).  Of
    equal payloads of at least ``least`` bytes the largest page_id is the
    response, others revisit it; repeated rows of that id are all responses.
    An empty table writes no archive.  Other columns are not archived.
    ``folder`` must be seen by all executors; by default one in
    ``spark.checkpoint.dir``.
    """
    folder = folder or f"{checkpoint_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    files = settle(write_archives(decisions(pages, least), f"{folder}/crawled"))
    index = settle(normalise(files, f"{folder}/normal"))
    return read_records(index)
