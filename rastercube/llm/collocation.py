"""Phrase collocations by Rabin-Karp fingerprints with pointers to occurrences."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, checked, mix64, settle, shuffle_partitions

LONGEST = 4
# Bytes of text in a chunk, n-grams of a bucket that meet in a task, bits of a fingerprint.
CHUNK_BYTES, BUCKET_GRAMS, BITS = 4_000_000, 1_500_000, 48
# What ends a piece, and the mark that stands for it (a byte that UTF-8 never has).
PIECE_ENDS, MARK = b".,;:!?\n\x0b\x0c\r", 0xFF
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd
_TABLE = bytes(MARK if c in PIECE_ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
CHUNKS = "lang string, words long, grams long, text binary"
BLOBS = "lang string, bucket int, chunk long, fingerprints binary, counts binary, pointers binary"


def tokens(text: bytes) -> bytes:
    """The lower-cased words of a text, one space apart, with a mark wherever a piece ends (ASCII lower case)."""
    return b" ".join(text.translate(_TABLE).replace(b"\xff", b" \xff ").split())


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Texts of one language packed into chunks; a piece never reaches over two texts."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    held: dict[str, list[bytes]] = {}
    amount: dict[str, int] = {}

    def packed(lang: str) -> pa.RecordBatch:
        joined = b" \xff ".join(held.pop(lang))
        amount.pop(lang)
        found = joined.split(b" ")
        marks = found.count(b"\xff")
        words = len(found) - marks
        return pa.RecordBatch.from_arrays([
            pa.array([lang]), pa.array([words], pa.int64()), pa.array([LONGEST * words], pa.int64()),
            pa.array([zstandard.compress(joined, 3)], pa.binary())], names=names)

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), byte_values(batch.column(1))
        for lang, text in zip(langs, texts):
            text = tokens(text or b"")
            if not text:
                continue
            held.setdefault(lang, []).append(text)
            amount[lang] = amount.get(lang, 0) + len(text)
            if amount[lang] >= size:
                yield packed(lang)
            elif sum(amount.values()) >= 4 * size:  # very many languages
                for x in list(held):
                    yield packed(x)
    for x in list(held):
        yield packed(x)


class Grams:
    """A chunk's word sequence, with prefix polynomials that give the fingerprint of any of its n-grams."""

    def __init__(self, text: bytes):
        self.tokens = text.split(b" ")
        ids: dict[bytes, int] = {b"\xff": 0}
        self.ids = np.fromiter((ids.setdefault(w, len(ids)) for w in self.tokens), np.int32, len(self.tokens))
        names = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in ids), np.uint64, len(ids))
        with np.errstate(over="ignore"):
            n = len(self.ids)
            power, self.undo = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, x))))
                                for x in (BASE, np.uint64(pow(int(BASE), -1, 1 << 64))))
            self.prefix = np.concatenate(([np.uint64(0)], np.cumsum(names[self.ids] * power[:-1])))
        # how many words follow from each place to the end of its piece
        ends = np.flatnonzero(np.append(self.ids, 0) == 0)
        self.room = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)

    def starts(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.room >= n)

    def fingerprints(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Of ``n`` words from each start: the upper bits tell the length and the polynomial, scrambled."""
        with np.errstate(over="ignore"):
            spans = (self.prefix[starts + n] - self.prefix[starts]) * self.undo[starts]
        return mix64(spans, n) >> np.uint64(64 - BITS)

    def counted(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(fingerprint, count, start)`` of the distinct n-grams, by the words and not only by fingerprint.

        Occurrences whose words differ from those of their fingerprint's first
        one stand for themselves, with a count of one.
        """
        starts = self.starts(n)
        found = self.fingerprints(starts, n)
        order = np.argsort(found, kind="stable")
        found, starts = found[order], starts[order]
        if not len(found):
            return found, np.empty(0, np.int64), starts
        head = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        count = np.diff(np.append(head, len(found)))
        first = np.repeat(starts[head], count)
        other = np.zeros(len(found), bool)
        for j in range(n):
            other |= self.ids[starts + j] != self.ids[first + j]
        if other.any():
            np.subtract.at(count, np.repeat(np.arange(len(head)), count)[other], 1)
            return (np.concatenate((found[head], found[other])), np.concatenate((count, np.ones(other.sum(), np.int64))),
                    np.concatenate((starts[head], starts[other])))
        return found[head], count, starts[head]


def _pack(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: the planes that are all zero take no room."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's n-grams, combined, cut by ranges of fingerprints; a pointer is a place times LONGEST plus n - 1."""
    names = [c.split()[0] for c in BLOBS.split(", ")]
    for batch in batches:
        for r in range(batch.num_rows):
            grams = Grams(zstandard.decompress(batch.column(2)[r].as_py()))
            parts = [(*grams.counted(n), n) for n in range(1, LONGEST + 1)]
            found = np.concatenate([p[0] for p in parts])
            count = np.concatenate([p[1] for p in parts]).astype(np.uint32)
            point = np.concatenate([p[2] * LONGEST + p[3] - 1 for p in parts]).astype(np.uint32)
            order = np.argsort(found, kind="stable")
            found, count, point = found[order], count[order], point[order]
            bucket = ((found >> np.uint64(BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(edges)).tolist():
                at = slice(edges[b], edges[b + 1])
                rows.append((batch.column(1)[r].as_py(), b, batch.column(0)[r].as_py(),
                             _pack(np.diff(found[at], prepend=np.uint64(0))), _pack(count[at]), _pack(point[at])))
            for i in range(0, len(rows), 4096):
                cols = list(zip(*rows[i:i + 4096]))
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)


def _frequent(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """For each chunk the occurrences in it whose fingerprint occurs often enough in the language, bucket by bucket."""
    held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    key = None

    def found() -> Iterator[pa.RecordBatch]:
        prints, counts, points = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        order = np.argsort(prints, kind="stable")
        p = prints[order]
        head = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        total = np.add.reduceat(counts[order].astype(np.int64), head)
        often = np.empty(len(p), bool)
        often[order] = np.repeat(total >= least, np.diff(np.append(head, len(p))))
        at, rows = 0, []
        for chunk, part, _, _ in held:
            keep = often[at: at + len(part)]
            if keep.any():
                rows.append((chunk, _pack(points[at: at + len(part)][keep]), _pack(counts[at: at + len(part)][keep])))
            at += len(part)
        for i in range(0, len(rows), 4096):
            cols = list(zip(*rows[i:i + 4096]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(cols, (pa.int64(), pa.binary(), pa.binary()))],
                names=["chunk", "pointers", "counts"])

    for batch in batches:
        for lang, bucket, chunk, prints, counts, points in zip(*(c.to_pylist() for c in batch.columns)):
            if (lang, bucket) != key:
                if held:
                    yield from found()
                held, key = [], (lang, bucket)
            held.append((chunk, np.cumsum(_unpack(prints, "u8"), dtype=np.uint64), _unpack(counts, "u4"), _unpack(points, "u4")))
    if held:
        yield from found()


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words at the pointers, read from the chunks' texts, with their counts there."""
    for batch in batches:
        for r in range(batch.num_rows):
            lang, text, points, counts = (batch.column(c)[r].as_py() for c in range(4))
            words = zstandard.decompress(text).split(b" ")
            for more, n in zip(points, counts):
                point = _unpack(more, "u4")
                at, size = (point // LONGEST).tolist(), (point % LONGEST + 1).tolist()
                phrases = [b" ".join(words[a:a + k]) for a, k in zip(at, size)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(at)), pa.array(size, pa.int32()), pa.array(phrases, pa.binary()).cast(pa.string()),
                    pa.array(_unpack(n, "u4").astype(np.int64))], names=["lang", "words", "phrase", "count"])


def frequent_phrases(docs: DataFrame, least: int = 30, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(lang, words, phrase, f)`` of the phrases of up to four words that occur ``least`` times, and ``(lang, n)``.

    Texts are packed into chunks.  Each chunk counts its n-grams, compared word
    by word, and sends for each a fingerprint, the count and a pointer to one
    occurrence; these meet by ranges of fingerprints.  Where the counts of a
    fingerprint reach ``least``, the chunks' pointers go back to the chunks,
    which read the words there.  Phrases are then counted by their words, so
    that fingerprints shared by several phrases make no count wrong, and no
    other phrase is ever written out.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    chunks = settle(texts.mapInArrow(partial(_chunks, size=CHUNK_BYTES), CHUNKS).withColumn(
        "chunk", F.monotonically_increasing_id()))
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    grams = chunks.agg(F.sum("grams")).first()[0] or 0
    buckets = max(1, -(-grams // BUCKET_GRAMS))
    parts = shuffle_partitions(docs)
    # a chunk is a task's piece of work, and only its number says which it is
    sent = chunks.select("chunk", "lang", "text").mapInArrow(partial(_fingerprints, buckets=buckets), BLOBS)
    back = sent.repartition(parts, "lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(
        partial(_frequent, least=least), "chunk long, pointers binary, counts binary")
    asked = settle(back).groupBy("chunk").agg(F.collect_list(F.struct("pointers", "counts")).alias("asked"))
    met = chunks.join(asked, "chunk").select("lang", "text", "asked.pointers", "asked.counts")
    read = met.mapInArrow(_phrases, "lang string, words int, phrase string, count long")
    counted = read.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("f"))
    return settle(counted.where(F.col("f") >= least)), totals


def _part(phrase: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def _whole(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """``(lang, phrase, words, a, l, r, score)`` of the phrases of two words and more, by the cut of the lowest score."""
    longer = frequent.where("words > 1")
    cuts = longer.select("lang", "phrase", "words", F.col("f").alias("a"),
                         F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("head", _part(F.col("phrase"), F.lit(1), F.col("k"))).withColumn(
        "tail", _part(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")))
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    cuts = cuts.withColumn("_a", _whole(F.col("a")) * F.lit(2000000).cast("decimal(7,0)")).withColumn(
        "_lr", F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))
    score = F.expr("_a div _lr").cast("long")
    low = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("low")
    return cuts.groupBy("lang", "phrase", "words", "a").agg(low).select(
        "lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def contained(frequent: DataFrame) -> DataFrame:
    """``(lang, phrase, most)``: for each phrase inside a longer one the longer one's count, the largest of several."""
    outer = frequent.where("words > 2")
    spans = outer.select("lang", "phrase", "words", "f", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    spans = spans.select("lang", "phrase", "f", "size", F.explode(F.sequence(
        F.lit(1), F.col("words") - F.col("size") + 1)).alias("first"))
    return spans.groupBy("lang", _part(F.col("phrase"), F.col("first"), F.col("size")).alias("phrase")).agg(
        F.max("f").alias("most"))


def collocations(docs: DataFrame, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into
    pieces; a phrase lies within a piece and occurs ``a`` times, ``least`` at
    least.  Cut after its first k words, its parts occur ``l`` and ``r`` times,
    and it scores floor(2000000 a / (l + r)); the cut of the lowest score
    counts, the least k of ties.  Phrases inside a longer frequent one with
    ``share`` percent of their count are left out.  ``n`` counts the
    language's words.  Order: score and a falling, phrase by its bytes.

    A null language counts as ``und``, a null text as empty; texts without
    words add nothing, repeated rows count as often as they are there, and an
    empty table gives no rows.  Other columns are left out.
    """
    frequent, totals = frequent_phrases(docs, least)
    inside = contained(frequent)
    found = scored(frequent).join(inside, ["lang", "phrase"], "left")
    found = found.where(F.col("most").isNull() | (_whole(F.col("most")) * 100 < _whole(F.col("a")) * share))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each part of a language's phrases before the parts meet
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs))))
    firsts = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    firsts = firsts.where(F.col("place") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(checked(settle(totals)), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = 30, share: int = 80, top: int = 2000) -> str:
    upper = "".join(map(chr, range(65, 91)))
    grams = " UNION ALL ".join(f"""
            SELECT lang, {k} AS words, array_to_string(w[i:i + {k - 1}], ' ') AS phrase
            FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p WHERE len(w) >= {k})"""
                               for k in range(1, LONGEST + 1))
    return rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
                   FROM (SELECT lang, unnest(regexp_split_to_array(
                             translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
                         FROM documents WHERE text IS NOT NULL)),
        n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
        f AS (SELECT lang, words, phrase, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
        c AS (SELECT lang, phrase, words, f, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
        cut AS (SELECT c.*, k, array_to_string(w[:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
                FROM c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < words),
        s AS (SELECT cut.lang, cut.phrase, cut.f AS a, cut.k, h.f AS l, t.f AS r,
                     2000000::HUGEINT * cut.f // (h.f::HUGEINT + t.f) AS score
              FROM cut JOIN f h ON h.lang = cut.lang AND h.phrase = cut.head JOIN f t ON t.lang = cut.lang AND t.phrase = cut.tail),
        low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        inner_of AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(f) AS most
                     FROM c, (SELECT unnest([2, 3]) AS z), (SELECT unnest([1, 2, 3]) AS i)
                     WHERE z < words AND i + z - 1 <= words GROUP BY ALL),
        kept AS (SELECT low.* FROM low LEFT JOIN inner_of o ON o.lang = low.lang AND o.phrase = low.phrase
                 WHERE o.most IS NULL OR 100::HUGEINT * o.most < {share}::HUGEINT * a)
        SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM kept JOIN n ON n.lang = kept.lang
        QUALIFY rank <= {top}"""
