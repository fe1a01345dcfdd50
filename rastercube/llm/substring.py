"""Removal of repeated passages, found by recompression of the token sequence."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rastercube.llm.common import WHITE, byte_values, mix64, shuffle_partitions

# Words handled at once in a task, words whose name a worker keeps, keys that a task remembers having sent.
CHUNK_WORDS, CACHE_WORDS, SENT_KEYS = 300_000, 500_000, 1 << 16
# Groups of symbols that a round deals out to the halves of the alphabet.
ROUNDS, GROUPS = 3, 256
# Odd multipliers of the running hashes (fixed values).
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
HITS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("row", pa.int64()), ("first", pa.int32()),
                  ("last", pa.int32()), ("sure", pa.bool_()), ("several", pa.bool_())])
HITS_DDL = "a long, b long, row long, first int, last int, sure boolean, several boolean"


class WordNames(dict):
    """A word's 128-bit name: equal for equal words in every task, so no table of names is needed."""

    def __missing__(self, word: bytes) -> bytes:
        name = xxhash.xxh3_128_digest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = name
        return name


_NAMES = WordNames()


def word_names(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the words' names."""
    both = np.frombuffer(b"".join(map(_NAMES.__getitem__, words)), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


class Symbols:
    """First symbols: 64-bit hashes of the words by prefix polynomials over a text's bytes, without splitting it.

    Only the rounds go by them, where a wrong agreement costs a comparison;
    what is removed is compared by :func:`word_names`.
    """

    def __init__(self) -> None:
        self.white = np.isin(np.arange(256), list(WHITE))
        self.value = mix64(np.arange(256, dtype=np.uint64), 7)
        self.power = self.undo = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if n > len(self.power):
            self.power, self.undo = (
                np.cumprod(np.concatenate(([np.uint64(1)], np.full(n - 1, x)))) for x in
                (BASES[0], np.uint64(pow(int(BASES[0]), -1, 1 << 64))))

    def __call__(self, texts: list[bytes], block: int = 1 << 20) -> np.ndarray:
        """Of all the texts' words, in order; about ``block`` bytes at a time, however long a text is."""
        data = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
        edge = np.flatnonzero(np.diff(self.white[data])) + 1
        start, end = edge[::2], edge[1::2]
        out = np.empty(len(start), np.uint64)
        cut = np.append(np.searchsorted(start, np.arange(0, len(data), block)), len(start))
        with np.errstate(over="ignore"):
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if a < b:
                    at = start[a]
                    part = self.value[data[at: end[b - 1]]]
                    self._reach(len(part))
                    prefix = np.concatenate(([np.uint64(0)], np.cumsum(part * self.power[: len(part)])))
                    out[a:b] = mix64((prefix[end[a:b] - at] - prefix[start[a:b] - at]) * self.undo[start[a:b] - at])
        return out


_SYMBOLS = Symbols()


def _group(name: np.ndarray, r: int) -> np.ndarray:
    """The group of each symbol in round ``r``; a round deals out whole groups to the halves of the alphabet."""
    return (mix64(name, 3 * r + 2) >> np.uint64(56)).astype(np.intp)


def _runs(name: np.ndarray, r: int) -> tuple[np.ndarray, np.ndarray]:
    """Name every run of a symbol by (symbol, length): names, and where the runs begin."""
    at = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
    run = np.append(at[1:], len(name)) - 1 - at
    return np.where(run > 0, mix64(name[at] ^ mix64(run.astype(np.uint64), 3 * r + 1)), name[at]), at


def _pairs(name: np.ndarray, r: int, half: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Name every pair of a symbol of the left half and one of the right half: names, where they begin, which are pairs, which begin left."""
    left = half[_group(name, r)]
    pair = np.append(left[:-1] & ~left[1:], False)
    keep = np.flatnonzero(~np.concatenate(([False], pair[:-1])))
    two = pair[keep]
    return np.where(two, mix64(name[keep] ^ (mix64(name[keep + two], 3 * r + 3) << np.uint64(1))), name[keep]), keep, two, left[keep]


def recompress(words: np.ndarray, halves: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(name, lo, hi)`` of the symbols after a round of naming runs, then pairs, for each of ``halves``.

    A round names every run of a symbol by (symbol, length), then every pair
    whose left symbol falls into the left half of the alphabet and whose right
    one into the right half; ``halves`` says for each round which groups of
    symbols are the left half (:func:`pairings`).  Names are hashes of what
    they stand for, so that they agree everywhere.  ``lo..hi``
    are the words that made the symbol come out as it did: its own and the
    neighbours that bounded its run or did not pair with it.  Wherever the
    words lo..hi occur, the same symbol stands at the same place; symbols that
    depend on the sequence's ends reach beyond them.  ``lo`` and ``hi`` never
    fall along the sequence.
    """
    n = len(words)
    name, lo, hi = words, np.arange(n), np.arange(n)
    for r, half in enumerate(halves):
        size = len(name)
        name, at = _runs(name, r)
        last = np.append(at[1:], size) - 1
        lo, hi = np.concatenate(([-1], lo[at[1:] - 1])), np.append(hi[last[:-1] + 1], n)
        name, keep, two, left = _pairs(name, r, half)
        # a single left symbol depends on what follows it, a single right one on what stands before it
        before, after = np.concatenate(([-1], lo[:-1])), np.append(hi[1:], n)
        lo, hi = np.where(~two & ~left, before[keep], lo[keep]), np.where(~two & left, after[keep], hi[keep + two])
    return name, lo, hi


def _neighbours(batches: Iterator[pa.RecordBatch], halves: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """How often a symbol of one group stands before one of another after these rounds and the next one's runs."""
    total = np.zeros(GROUPS * GROUPS, np.int64)
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            name = _SYMBOLS([t or b"" for t in byte_values(batch.column(0).slice(i, 256))])
            if len(name):
                for r, half in enumerate(halves):
                    name = _pairs(_runs(name, r)[0], r, half)[0]
                group = _group(_runs(name, len(halves))[0], len(halves))
                total += np.bincount(group[:-1] * GROUPS + group[1:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["at", "n"])


def split_groups(count: np.ndarray) -> np.ndarray:
    """Which groups are the left half, for ``count`` of (group, next group): at least a quarter of the pairs of
    different groups then have their left symbol in it and their right one in the other half.

    Groups are dealt out by falling weight, each to the half that parts it
    from more of its neighbours dealt before; so at least half of these pairs
    are parted, and the halves are named so that most of them go from left to right.
    """
    both = count + count.T
    np.fill_diagonal(both, 0)
    side = np.zeros(len(count), np.int64)
    for g in np.lexsort((np.arange(len(count)), -both.sum(axis=1))).tolist():
        pull = int(both[g] @ side) or int(side.sum())
        side[g] = -1 if pull > 0 else 1
    left = side > 0
    return ~left if count[~left][:, left].sum() > count[left][:, ~left].sum() else left


def pairings(texts: DataFrame, rounds: int) -> list[np.ndarray]:
    """The halves of the alphabet for each round, from counts of neighbouring symbols over all texts (one string column).

    A round is one Spark job: every task names runs and pairs as the rounds
    before have settled, and counts its neighbours by group; Spark sums the
    counts, at most ``GROUPS * GROUPS`` rows whatever the corpus' size, and the
    driver deals out the groups.  No token is moved.  Neighbours across texts
    that a task reads together count too; the halves only decide how well
    symbols grow, never what is removed.
    """
    halves: list[np.ndarray] = []
    for _ in range(rounds):
        met = texts.mapInArrow(partial(_neighbours, halves=list(halves)), "at int, n long")
        met = met.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        count = np.zeros(GROUPS * GROUPS, np.int64)
        count[met.column("at").to_numpy()] = met.column("n").to_numpy()
        halves.append(split_groups(count.reshape(GROUPS, GROUPS)))
    return halves


class Spans:
    """Hashes of spans of a chunk's words, the same wherever the words stand."""

    def __init__(self, words: np.ndarray, base: np.uint64):
        with np.errstate(over="ignore"):
            power, self.undo = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(words), x))))
                                for x in (base, np.uint64(pow(int(base), -1, 1 << 64))))
            self.prefix = np.concatenate(([np.uint64(0)], np.cumsum(words * power[:-1])))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.prefix[hi + 1] - self.prefix[lo]) * self.undo[lo])


def _least(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """For each range lo..hi of positions the one of the least key, the leftmost of ties; -1 for an empty range."""
    out = np.full(len(lo), -1)
    width = hi - lo + 1
    level, step = np.arange(len(key)), 1
    while step <= max(1, int(width.max(initial=0))):
        if step > 1:
            a, b = level[: len(level) - step // 2], level[step // 2:]
            level = np.where(key[b] < key[a], b, a)
        at = np.flatnonzero((width >= step) & (width < 2 * step))
        if len(at):
            a, b = level[lo[at]], level[hi[at] - step + 1]
            out[at] = np.where(key[b] < key[a], b, a)
        step *= 2
    return out


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int,
            chunk_words: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Parts of batches with their texts' words, up to about ``chunk_words`` words unless one text has more."""
    for batch in batches:
        begin, words, size = 0, [], 0
        for i in range(0, batch.num_rows, 16):
            found = [(t or b"").split() for t in byte_values(batch.column(text_at).slice(i, 16))]
            words += found
            size += sum(map(len, found))
            done = min(i + 16, batch.num_rows)
            if size >= chunk_words or done == batch.num_rows:
                yield batch.slice(begin, done - begin), words
                begin, words, size = done, [], 0


def _starts(words: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(base, document, start)``: each text's first position in the chunk, and every window's text and position."""
    size = np.array([len(w) for w in words])
    base = np.concatenate(([0], np.cumsum(size)))
    count = np.maximum(size - window + 1, 0)
    doc = np.repeat(np.arange(len(words)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + base[doc]
    return base, doc, start


class Sent:
    """Keys (a, b) that a task has sent on for the others to meet; a key that is forgotten is merely sent again."""

    def __init__(self, most: int = SENT_KEYS):
        self.most = most
        self.keys = np.empty((3, 0), np.uint64)  # one number for the key, by which they are sorted, and both parts
        self.used = np.empty(0, bool)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key, (one, x, y) = a ^ mix64(b), self.keys
        if not len(one):
            return np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(one, key), len(one) - 1)
        found = (x[at] == a) & (y[at] == b)
        self.used[at[found]] = True
        return found

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Remember keys that it does not have; when full, those that were never met again are forgotten."""
        if self.keys.shape[1] + len(a) > self.most:
            self.keys, self.used = self.keys[:, self.used], np.zeros(int(self.used.sum()), bool)
        room = max(0, self.most - self.keys.shape[1])
        keys = np.concatenate((self.keys, np.stack((a ^ mix64(b), a, b))[:, :room]), axis=1)
        used = np.append(self.used, np.zeros(keys.shape[1] - len(self.used), bool))
        order = np.argsort(keys[0], kind="stable")
        self.keys, self.used = keys[:, order], used[order]


def _hits(a: np.ndarray, b: np.ndarray, row: np.ndarray, first: np.ndarray, last: np.ndarray, sent: Sent,
          told: Sent | None = None) -> pa.RecordBatch:
    """Rows to be met with others of equal a, combined with what the task has ``sent`` before.

    Of rows of equal (a, b) one goes on, marked as sure; the others are sure
    too.  With ``told``, of an a with several b one row goes on, marked so;
    the others need not be met to know that they must be compared, and the a
    is remembered in ``told``.  What does not go on is dealt out evenly under
    names of its own.  So a task sends a hot key a few times, however often
    it has it.
    """
    order = np.lexsort((b, a))
    same_a = np.concatenate(([False], a[order][1:] == a[order][:-1]))[: len(a)]
    same = same_a & np.concatenate(([False], b[order][1:] == b[order][:-1]))[: len(a)]
    again, sure, several = np.empty(len(a), bool), np.empty(len(a), bool), np.zeros(len(a), bool)
    again[order] = same
    sure[order] = same | np.append(same[1:], False)
    known = sent.has(a, b)
    again |= known
    sure |= known
    own = again.copy()
    if told is not None:
        zero = np.zeros_like(a)
        known = told.has(a, zero)
        group = np.cumsum(~same_a) - 1  # of each a, in this order
        contexts = np.bincount(group[~same], minlength=1)
        several[order] = (contexts > 1)[group]
        several = (several | known) & ~again
        at = order[several[order]]  # by a; the first of each speaks for it
        speaks = np.concatenate(([True], a[at][1:] != a[at][:-1]))[: len(at)] & ~known[at]
        own[at[~speaks]] = True
        told.add(a[at[speaks]], zero[at[speaks]])
    met = sure & ~again
    sent.add(a[met], b[met])
    name = mix64(mix64(row.view(np.uint64)) ^ first.astype(np.uint64), 77)
    a, b = np.where(own, name, a), np.where(own, mix64(name, 78), b)
    # neighbours among those that are only sure need one row
    on = np.zeros(len(a), bool)
    on[1:] = again[1:] & again[:-1] & (row[1:] == row[:-1]) & (first[1:] == last[:-1] + 1)
    head = np.flatnonzero(~on)
    a, b, row, first, last, sure, several = (
        a[head], b[head], row[head], first[head], last[np.append(head[1:], len(on)) - 1], sure[head], several[head])
    return _batch(a, b, row, first, last, sure, several)


def _batch(a, b, row, first, last, sure, several) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(row), pa.array(first.astype(np.int32)),
         pa.array(last.astype(np.int32)), pa.array(sure), pa.array(several)], schema=HITS)


def _anchors(batches: Iterator[pa.RecordBatch], window: int, halves: list[np.ndarray], chunk_words: int) -> Iterator[pa.RecordBatch]:
    """For every run of windows with the same anchor a row (anchor, context, windows first..last).

    A window's anchor is, of the symbols that its words fix, the one of least
    name; it goes by the hash of the words that fix it.  Equal windows have
    equal anchors.  The context is a hash of all words of the run's windows, by
    both halves of their names.
    A window without such a symbol (one with very long runs) stands for itself.
    """
    sent, told = Sent(), Sent()
    for batch, words in _chunks(batches, 2, chunk_words):
        base, doc, start = _starts(words, window)
        if not len(start):
            continue
        flat = [w for text in words for w in text]
        symbols = _SYMBOLS([b" ".join(flat)])
        names, more = word_names(flat)
        name, lo, hi = recompress(symbols, halves)
        # symbols lo >= start and hi < start + window stand side by side
        left = np.searchsorted(lo, start, "left")
        right = np.searchsorted(hi, start + window, "left") - 1
        anchor = _least(mix64(name, 99), left, right)
        head = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (doc[1:] != doc[:-1])))
        at = np.flatnonzero(head)
        end = np.append(at[1:], len(head)) - 1
        own = anchor[at] < 0
        first = np.where(own, start[at], lo[anchor[at]])
        last = np.where(own, start[at] + window - 1, hi[anchor[at]])
        # the length beside the words; 0 keeps windows that stand for themselves apart
        length = np.where(own, 0, last - first + 1).astype(np.uint64)
        a = mix64(Spans(symbols, BASES[0])(first, last) ^ mix64(length, 98))
        b = mix64(Spans(names, BASES[1])(start[at], start[end] + window - 1), 2)
        b ^= Spans(more, BASES[0])(start[at], start[end] + window - 1)
        row = batch.column(0).to_numpy()[doc[at]]
        yield _hits(a, b, row, start[at] - base[doc[at]], start[end] - base[doc[at]], sent, told)


def _spans(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """``(place in the column, field -> values)`` of all spans of a column of lists."""
    size = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = column.flatten()
    return np.repeat(np.arange(len(column)), size), {
        f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def _covered(at: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in one of the spans at..last."""
    change = np.bincount(at, minlength=n + 1) - np.bincount(last + 1, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _candidates(batches: Iterator[pa.RecordBatch], window: int, chunk_words: int) -> Iterator[pa.RecordBatch]:
    """The runs found equal as a whole, joined; and every window of runs to be compared, by a hash of each half of its words' names."""
    sent = Sent()
    for batch, words in _chunks(batches, 2, chunk_words):
        base, doc, start = _starts(words, window)
        rows = batch.column(0).to_numpy()
        place, span = _spans(batch.column(3))
        first, last = span["first"] + base[place], span["last"] + base[place]
        done = _covered(first[span["done"]], last[span["done"]], int(base[-1]))
        edge = np.zeros(int(base[-1]) + 1, bool)
        edge[base] = True  # runs do not cross texts
        head = np.flatnonzero(done & (edge[:-1] | ~np.concatenate(([False], done[:-1]))))
        end = np.flatnonzero(done & (edge[1:] | ~np.append(done[1:], False)))
        at = np.searchsorted(base, head, "right") - 1
        if len(head):
            own = mix64(mix64(rows[at].view(np.uint64)) ^ (head - base[at]).astype(np.uint64), 79)
            yield _batch(own, mix64(own, 80), rows[at], head - base[at], end - base[at], np.ones(len(head), bool),
                         np.zeros(len(head), bool))
        chosen = _covered(first[span["compare"]], last[span["compare"]], int(base[-1]))[start]
        doc, start = doc[chosen], start[chosen]
        if len(start):
            names = word_names([w for text in words for w in text])
            a, b = (Spans(half, x)(start, start + window - 1) for half, x in zip(names, BASES))
            yield _hits(a, b, rows[doc], start - base[doc], start - base[doc], sent)


def _remove(batches: Iterator[pa.RecordBatch], window: int, chunk_words: int) -> Iterator[pa.RecordBatch]:
    for batch, words in _chunks(batches, 2, chunk_words):
        base = np.concatenate(([0], np.cumsum([len(w) for w in words])))
        place, span = _spans(batch.column(3))
        gone = _covered(span["first"] + base[place], span["last"] + base[place] + window - 1, int(base[-1]))
        removed = np.concatenate(([0], np.cumsum(gone)))[base]
        removed = removed[1:] - removed[:-1]
        kept = [b" ".join(compress(w, (~gone[i: i + len(w)]).tolist()) if r else w)
                for w, i, r in zip(words, base.tolist(), removed.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(np.diff(base)), pa.array(removed)],
            names=["doc_id", "kept_text", "n_words", "n_removed"])


def remove_repeats(docs: DataFrame, window: int = 35, rounds: int = ROUNDS, id_col: str = "doc_id",
                   text_col: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """A row per document: doc_id, kept_text, n_words, n_removed.

    Removed is every word covered by a ``window`` of consecutive words whose
    sequence also starts anywhere else, in the same document too; windows are
    judged on the input.  First :func:`pairings` settles, in a Spark job for
    each round, which symbols pair.  Then three passes over documents dealt
    out evenly (all three read one shuffle of the texts):

    1. :func:`recompress` names runs and pairs in rounds; every window's
       anchor (:func:`_anchors`) goes to where equal anchors meet.
       Runs whose contexts are equal too repeat as a whole.  Of runs of one
       anchor with different contexts, one for each context goes on.
    2. Their windows are verified one by one, by all their words (128 bits of
       hash over 128-bit names), again where equal ones meet.
    3. Words under verified windows are taken out.

    A passage repeated very often, and a phrase that very many passages share,
    are combined in each task first (:func:`_hits`, over the whole task by
    :class:`Sent`), so that what meets in one task does not grow with their
    number; a row's spans are bounded by its own length.  ``chunk_words`` is
    how many words a task works on at once.  Null and short texts lose nothing; repeated
    rows are copies of each other, so all windows of each go; a null id stays;
    an empty table gives none; other columns are left out.
    """
    if window < 1 or rounds < 1:
        raise ValueError("window and rounds must be positive")
    parts = shuffle_partitions(docs)
    halves = pairings(docs.select(F.col(text_col).cast("string")), rounds)
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text")).repartition(parts, "row")
    hits = texts.mapInArrow(partial(_anchors, window=window, halves=halves, chunk_words=chunk_words), HITS_DDL).repartition(parts, "a")
    equal = Window.partitionBy("a", "b")
    anchor = Window.partitionBy("a")
    hits = hits.withColumn("nth", F.row_number().over(equal.orderBy("row", "first"))).withColumn(
        "equal", F.count("*").over(equal)).withColumn("all", F.count("*").over(anchor)).withColumn(
        "others", F.bool_or("several").over(anchor))
    hits = hits.withColumn("done", F.expr("sure or equal > 1")).withColumn(
        "compare", F.expr("(all > equal or others) and nth = 1"))
    found = hits.where("done or compare").groupBy("row").agg(
        F.collect_list(F.struct("first", "last", "done", "compare")).alias("spans"))
    near = texts.join(found.hint("shuffle_hash"), "row")
    hits = near.mapInArrow(partial(_candidates, window=window, chunk_words=chunk_words), HITS_DDL).repartition(parts, "a", "b")
    hits = hits.withColumn("equal", F.count("*").over(equal)).where("sure or equal > 1")
    true = hits.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return texts.join(true.hint("shuffle_hash"), "row", "left").mapInArrow(
        partial(_remove, window=window, chunk_words=chunk_words), "doc_id long, kept_text string, n_words long, n_removed long")
