"""Masked pseudo-likelihood scores from a small bidirectional window network."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import byte_values, mix64, settle

WIDTH, REACH = 16, 2
OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
BATCH, TEXTS, SCALE, CACHE_WORDS = 8192, 256, 1 << 24, 500_000
# So many of the most frequent tokens, at most, are known to every task; others are joined. Count of an unseen token.
HEAD, UNSEEN = 1 << 17, 0.5


class Vocabulary(NamedTuple):
    """What the network predicts: ``side * side`` classes of tokens.

    ``head`` are the most frequent tokens in falling order, ``n`` their
    counts; the first ``own`` of them are a class each, all other tokens are
    hashed among the remaining classes.  Tokens whose count falls below the
    step ``least`` are not in ``head``.  A token's code is its place in
    ``head``, or ``len(head)`` and its hash among the remaining classes.
    ``share`` is, by code, log of the token's part in its class, for a code
    beyond ``head`` that of a token never seen.
    """
    side: int
    own: int
    head: list[bytes]
    n: np.ndarray
    least: int
    share: np.ndarray

    @property
    def rest(self) -> int:
        return self.side * self.side - self.own

    def classes(self) -> np.ndarray:
        """The class of every code."""
        hashed = [mark(t) % self.rest for t in self.head[self.own:]]
        return np.concatenate((np.arange(self.own), self.own + np.array(hashed, np.int64), self.own + np.arange(self.rest)))


class Codes(dict):
    """Codes of tokens; those beyond the head are hashed, not kept."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(zip(vocabulary.head, range(len(vocabulary.head))))
        self.first, self.rest = len(vocabulary.head), vocabulary.rest

    def __missing__(self, token: bytes) -> int:
        return self.first + mark(token) % self.rest


def mark(token: bytes) -> int:
    """63 bits of hash."""
    return xxhash.xxh3_64_intdigest(token) >> 1


def shapes(side: int) -> list[tuple[str, tuple[int, ...]]]:
    """The network's arrays; classes are numbered (a, b), a < side, b < side, and the last row of the embeddings stands for "no word"."""
    return [("embed", (len(OFFSETS) * (side * side + 1), WIDTH)), ("out_a", (WIDTH, side)), ("bias_a", (side,)),
            ("out_b", (WIDTH, side)), ("bias_b", (side, side))]


def views(flat: np.ndarray, side: int) -> dict[str, np.ndarray]:
    """The network's arrays as views of one vector."""
    out, at = {}, 0
    for name, shape in shapes(side):
        n = int(np.prod(shape))
        out[name] = flat[at: at + n].reshape(shape)
        at += n
    return out


def start(seed: int, side: int) -> np.ndarray:
    size = sum(int(np.prod(s)) for _, s in shapes(side))
    flat = (np.random.default_rng(seed).standard_normal(size) * 0.1).astype(np.float32)
    net = views(flat, side)
    net["bias_a"][:] = net["bias_b"][:] = 0
    return flat


def sequence(found: list[np.ndarray], none: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(classes, positions, document)``: the texts' classes one after another with ``REACH`` blanks around each."""
    size = np.array([len(w) for w in found], np.int64)
    first = REACH + np.concatenate(([0], np.cumsum(size + REACH)))[:-1]
    doc = np.repeat(np.arange(len(found)), size)
    position = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[doc]
    classes = np.full(int(size.sum()) + REACH * (len(found) + 1), none, np.int64)
    if len(doc):
        classes[position] = np.concatenate(found)
    return classes, position, doc


def _softmax(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(exponentials, their sums, log of the norm)`` by column; ``x`` is used up."""
    top = x.max(axis=0)
    np.exp(np.subtract(x, top, out=x), out=x)
    total = x.sum(axis=0)
    return x, total, top + np.log(total)


def forward(net: dict, classes: np.ndarray, at: np.ndarray) -> tuple:
    """Hidden layer, both softmaxes (a column per word) and log p of the words at ``at``, each seen only through its neighbours."""
    side = len(net["bias_a"])
    rows = [classes[at + o] for o in OFFSETS]
    hidden = net["embed"].take(rows[0], axis=0)
    for j in range(1, len(OFFSETS)):
        hidden += net["embed"][j * (side * side + 1): (j + 1) * (side * side + 1)].take(rows[j], axis=0)
    np.tanh(hidden, out=hidden)
    a, b = np.divmod(classes[at], side)
    line = np.arange(len(at))
    score_a = net["out_a"].T @ hidden.T
    score_a += net["bias_a"][:, None]
    score_b = net["out_b"].T @ hidden.T
    score_b += net["bias_b"].T.take(a, axis=1)
    chosen = score_a[a, line] + score_b[b, line]
    soft_a, total_a, norm_a = _softmax(score_a)
    soft_b, total_b, norm_b = _softmax(score_b)
    return rows, hidden, a, b, soft_a, soft_b, total_a, total_b, chosen - norm_a - norm_b


def train(flat: np.ndarray, squares: np.ndarray, side: int, classes: np.ndarray, at: np.ndarray, rate: float) -> None:
    """One Adagrad step on the masked words at ``at``, in place."""
    net, grad = views(flat, side), np.zeros_like(flat)
    rows, hidden, a, b, soft_a, soft_b, total_a, total_b, _ = forward(net, classes, at)
    line, g = np.arange(len(at)), views(grad, side)
    soft_a /= total_a
    soft_b /= total_b
    soft_a[a, line] -= 1
    soft_b[b, line] -= 1
    one = np.zeros((side, len(at)), np.float32)
    one[a, line] = 1
    g["out_a"][:], g["bias_a"][:] = hidden.T @ soft_a.T, soft_a.sum(axis=1)
    g["out_b"][:], g["bias_b"][:] = hidden.T @ soft_b.T, one @ soft_b.T
    back = (soft_a.T @ net["out_a"].T + soft_b.T @ net["out_b"].T) * (1 - hidden * hidden)
    for j, r in enumerate(rows):
        if side * side < 1 << 16:
            r = r.astype(np.uint16)  # sorted by radix
        order = np.argsort(r, kind="stable")
        r = r[order]
        head = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        g["embed"][r[head] + np.int64(j * (side * side + 1))] = np.add.reduceat(back.take(order, axis=0), head)
    grad /= len(at)
    squares += grad * grad
    flat -= rate * grad / (np.sqrt(squares) + 1e-6)


def targets(salt: np.ndarray, doc: np.ndarray, rounds: int, turn: int) -> np.ndarray:
    """Which words of the texts are masked in round ``turn``: of the ``rounds`` rounds every word is in exactly one.

    The round is a hash of the text (``salt``) and the place in it, so it is
    the same wherever and in whichever order the texts are read.
    """
    first = np.searchsorted(doc, np.arange(len(salt)))
    with np.errstate(over="ignore"):
        place = mix64((np.arange(len(doc)) - first[doc]).astype(np.uint64) + salt.astype(np.uint64)[doc])
    return place % np.uint64(rounds) == np.uint64(turn)


def token_counts(texts: DataFrame) -> DataFrame:
    """``(token, mark, n)``: how often every lower-cased word is in the texts (one string column), and its hash.

    Counts are combined in the tasks and summed by Spark; the table stays
    distributed, settled, and grows with the vocabulary of the corpus.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([mark(w) for w in words], pa.int64()),
                 pa.array(list(held.values()), pa.int64())], names=["token", "mark", "n"])
            held.clear()
            return out

        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                for t in byte_values(batch.column(0).slice(i, TEXTS)):
                    held.update((t or b"").lower().split())
                if len(held) >= CACHE_WORDS:
                    yield flush()
        if held:
            yield flush()

    found = texts.mapInArrow(count, "token binary, mark long, n long")
    return settle(found.groupBy("token").agg(F.first("mark").alias("mark"), F.sum("n").alias("n")))


def _step() -> Column:
    return F.floor(F.log2("n") * 8)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The classes for a corpus of such :func:`token_counts`.

    Their number grows as the fourth root of the corpus' words (about 11 times
    it: 300 for half a million words, 1,000 for 85 million, 2,900 for five
    thousand million); up to half of them are the most frequent tokens.  The
    head has at most ``HEAD`` tokens and whole steps of an eighth in log2 of
    the count, so no other token has much more than a ``HEAD``-th of the words.
    """
    by_step = counts.groupBy(_step().alias("s")).agg(F.count("*"), F.sum("n")).collect()
    words = sum(n for _, _, n in by_step)
    side = max(8, math.ceil(3.3 * words ** 0.125))
    least, held = 0, 0
    for s, tokens, _ in sorted(by_step, reverse=True):
        held += tokens
        if held > HEAD:
            least = s + 1
            break
    common = counts.where(_step() >= least).select("token", "n").toArrow()
    ranked = sorted(zip(common.column(1).to_pylist(), common.column(0).to_pylist()), key=lambda x: (-x[0], x[1]))
    head, n = [t for _, t in ranked], np.array([k for k, _ in ranked], np.int64)
    own = min(side * side // 2, len(head))
    bare = Vocabulary(side, own, head, n, least, np.zeros(0))
    # words and tokens of the classes that several tokens share
    total = np.zeros(side * side)
    np.add.at(total, bare.classes()[own: len(head)], n[own:] + UNSEEN)
    of = F.pmod("mark", F.lit(bare.rest)).alias("c")
    for c, k, tokens in counts.where(_step() < least).groupBy(of).agg(F.sum("n"), F.count("*")).collect():
        total[own + c] += k + UNSEEN * tokens
    share = np.log(UNSEEN) - np.log(total[bare.classes()] + UNSEEN)
    share[: len(head)] += np.log1p(n / UNSEEN)
    share[:own] = 0
    return bare._replace(share=share)


def encode(docs: DataFrame, known: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(row, doc_id, salt, codes, rare)``, settled: each text as its tokens' 32-bit codes, and the tokens beyond the head.

    Training and scoring read this table, so texts are not split again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Codes(known)
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                words = [(t or b"").lower().split() for t in byte_values(part.column(2))]
                ends = np.concatenate(([0], np.cumsum([len(w) for w in words])))
                flat = list(chain.from_iterable(words))
                found = np.fromiter(map(code.__getitem__, flat), np.dtype("<i4"), len(flat))
                codes = [found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                others = np.flatnonzero(found >= code.first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([mark(c) for c in codes], pa.int64()), pa.array(codes, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.searchsorted(others, ends).astype(np.int32)),
                                              pa.array([flat[j] for j in others.tolist()], pa.binary()))],
                    names=["row", "doc_id", "salt", "codes", "rare"])

    return settle(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string")).mapInArrow(
            run, "row long, doc_id long, salt long, codes binary, rare array<binary>"))


def _classes(column: pa.Array, of: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Parts of a column of codes: ``(first row, classes of each text, codes of all)``."""
    for i in range(0, len(column), TEXTS):
        found = [np.frombuffer(c, np.dtype("<i4")) for c in column.slice(i, TEXTS).to_pylist()]
        yield i, [of[c] for c in found], np.concatenate(found)


def fit(encoded: DataFrame, known: Vocabulary, rounds: int = 2, rate: float = 0.05, seed: int = 7) -> np.ndarray:
    """Train the network over all encoded texts; returns its weights as one vector.

    In every round each part of the texts starts from the common weights and
    learns from its own: the rounds share the words out by a hash
    (:func:`targets`), so over all rounds each word of the corpus is masked
    and predicted from both sides once.  The parts' changes, weighted by their
    masked words, are summed by Spark (in whole numbers, so the order does not
    matter) and averaged.  Parts are dealt out and ordered by the documents'
    ids and texts, and their number follows from the corpus' words alone; so
    the weights do not depend on how the table is partitioned.  What is
    gathered grows with the number of parts, which is the words over 2**18 to
    the power 0.6; the driver gets one vector of the network's size.
    """
    side, weights = known.side, start(seed, known.side)
    of = known.classes()
    words = encoded.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0))).first()[0] // 4
    parts = max(1, math.ceil((words / 2**18) ** 0.6))
    dealt = encoded.select("doc_id", "salt", "codes").where("octet_length(codes) > 0").repartition(
        parts, "doc_id", "salt").sortWithinPartitions("doc_id", "salt").select("salt", "codes")
    for turn in range(rounds):
        given = weights

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            flat, squares, n = given.copy(), np.zeros_like(given), 0
            for batch in batches:
                salt = batch.column(0).to_numpy()
                for i, found, _ in _classes(batch.column(1), of):
                    classes, position, doc = sequence(found, side * side)
                    masked = position[targets(salt[i: i + TEXTS], doc, rounds, turn)]
                    for k in range(0, len(masked), BATCH):
                        train(flat, squares, side, classes, masked[k: k + BATCH], rate)
                    n += len(masked)
            change = np.rint((flat - given).astype(np.float64) * SCALE).astype(np.int64)
            for k in range(0, len(given) if n else 0, BATCH):
                rows = np.arange(k, min(k + BATCH, len(given)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.astype(np.int32)), pa.array(change[rows]), pa.array(np.full(len(rows), n))],
                    names=["at", "change", "n"])

        summed = dealt.mapInArrow(learn, "at int, change long, n long").groupBy("at").agg(
            F.sum(F.col("change").cast("decimal(38,0)") * F.col("n")).alias("total"), F.sum("n").alias("n"))
        mean = summed.select("at", (F.col("total") / F.col("n")).cast("double").alias("mean")).toArrow()
        if not mean.num_rows:
            continue
        weights = weights.copy()
        weights[mean.column("at").to_numpy()] += (mean.column("mean").to_numpy() / SCALE).astype(np.float32)
    return weights


def scores(encoded: DataFrame, known: Vocabulary, weights: np.ndarray, counts: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)`` of every encoded row under a fitted network.

    The probability of a token is that of its class by the network times that
    of the token in its class: 1 where the class is its own, else (n +
    ``UNSEEN``) / (words + ``UNSEEN`` * (tokens + 1)) by the counts of the
    class; the one more is what all unseen tokens share.  Counts of the head
    are known to the tasks, those of other tokens are joined.  Sums are of
    whole numbers, so the order does not matter.
    """
    of, share = known.classes(), known.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = views(weights, known.side)
        for batch in batches:
            total, count = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for i, found, codes in _classes(batch.column(2), of):
                classes, position, doc = sequence(found, known.side * known.side)
                gain = share[codes]
                for k in range(0, len(position), BATCH):
                    gain[k: k + BATCH] += forward(net, classes, position[k: k + BATCH])[-1]
                total += np.bincount(doc + i, gain, batch.num_rows)
                count += np.bincount(doc + i, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(count), pa.array(np.rint(total * SCALE).astype(np.int64))],
                names=["row", "doc_id", "n_tokens", "total"])

    out = encoded.select("row", "doc_id", "codes").mapInArrow(run, "row long, doc_id long, n_tokens long, total long")
    gain = F.rint(F.log1p(F.col("n") / UNSEEN) * SCALE).cast("long")
    gains = counts.where(_step() < known.least).select("token", gain.alias("total"))
    added = encoded.select("row", F.explode("rare").alias("token")).join(gains, "token").select(
        "row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"), "total")
    out = out.unionByName(added).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("total").alias("total"))
    total = F.round(F.col("total") / SCALE, 2)
    return out.select("doc_id", "n_tokens", total.alias("log_likelihood"),
                      F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Score every document by the summed conditional log-probabilities of its words.

    All tokens, lower-cased words, are counted (:func:`token_counts`); the
    frequent ones become outputs of the network, the others share hashed
    classes (:func:`vocabulary`).  The network is fitted on all texts
    (:func:`fit`, whose options are passed on); then every token is predicted
    from the two on either side, and the log-probabilities of its class (as a
    pair of softmaxes, the second given the first) and of the token in its
    class are summed (:func:`scores`).  Partitioning the table otherwise does
    not change a score.  Null and empty texts have no tokens, sum 0 and a null
    mean; repeated rows are learnt from and scored each; a null id stays; an
    empty table gives none; other columns are left out.
    """
    counts = token_counts(docs.select(F.col(text_col).cast("string")))
    known = vocabulary(counts)
    encoded = encode(docs, known, id_col, text_col)
    return scores(encoded, known, fit(encoded, known, **options), counts)
