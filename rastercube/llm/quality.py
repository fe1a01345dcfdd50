"""Quality rules whose cutoffs carry a bound on wrongly rejected documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.llm.common import WHITE, byte_values, checked, settle

SYMBOLS = b"#*$%&|<>"
DDL = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DDL.split(", ")])
# Rules: a value per document, of which large ones speak against it, and the cutoffs tried, least severe first.
RULES = {
    "symbols": ("n_symbols / greatest(n_words, 1)", (1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    "dup_lines": ("n_dup_lines", (50, 20, 10, 5, 3, 2)),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", (0.45, 0.4, 0.3, 0.25, 0.2, 0.15)),
    "long_words": ("word_chars / greatest(n_words, 1)", (40.0, 20.0, 15.0, 12.0, 10.0, 9.0)),
}


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    words = text.split()
    n_symbols = len(text) - len(text.translate(None, SYMBOLS))
    chars = len(text.decode("utf-8", "replace")) - (len(text) - len(text.translate(None, WHITE)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(windows)) < len(windows):
        count, reach = Counter(windows), 0
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeat += i + 3 - max(reach, i)
                reach = i + 3
    return len(words), chars, n_symbols, len(lines) - len(set(lines)), repeat


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = list(zip(*[text_counts(t or b"") for t in byte_values(batch.column(2))])) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], *[pa.array(c, pa.int64()) for c in cols]], schema=SCHEMA)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """The base counts of every row."""
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit("all")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(stratum, F.lit("")).alias("stratum"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(_count, DDL)


def upper_bound(failures: int, n: int, delta: float) -> float:
    """The exact (Clopper-Pearson) upper bound: the rate at which <= ``failures`` of ``n`` has probability ``delta``."""
    if failures >= n:
        return 1.0

    def below(p: float) -> float:
        # log-sum of the binomial terms up to ``failures``; below the mean they fall, so the sum ends early
        a, b, top = math.log(p), math.log1p(-p), []
        for k in range(failures, -1, -1):
            top.append(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * a + (n - k) * b)
            if top[-1] < top[0] - 50:
                break
        return top[0] + math.log(sum(math.exp(t - top[0]) for t in top))

    lo, hi, goal = failures / n, 1.0, math.log(delta)
    for _ in range(60):
        mid = (lo + hi) / 2
        if 0 < mid < 1 and below(mid) > goal:
            lo = mid
        else:
            hi = mid
    return hi


def certify(held: dict, alpha: float, delta: float) -> dict:
    """``{(stratum, rule): cutoff}`` from ``{(stratum, rule): (good documents, [wrongly rejected at each cutoff])}``.

    Every rule gets an equal part of ``alpha``, so that their sum holds for
    the document, and every cell tested an equal part of ``delta`` (Bonferroni
    over strata and rules).  Within a cell cutoffs are tried from the least
    severe on and the first failure stops it, which needs no more correction.
    """
    rules = len({r for _, r in held}) or 1
    chosen = {}
    for (stratum, rule), (n, wrong) in held.items():
        for cutoff, failures in zip(RULES[rule][1], wrong):
            # a rate above the goal cannot be certified
            if not n or failures > n * alpha / rules or upper_bound(failures, n, delta / len(held)) > alpha / rules:
                break
            chosen[stratum, rule] = cutoff
    return chosen


def failed_base(n_words, n_repeat_words, min_words: int, max_repeat_percent: int):
    """The base test, for columns as for numbers."""
    return (n_words < min_words) | (100 * n_repeat_words > max_repeat_percent * n_words)


def cutoffs(made: DataFrame, labels: DataFrame, alpha: float, delta: float) -> dict:
    """Certified ``{(stratum, rule): cutoff}`` for counted documents with ``base_failed``."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    sums = [F.sum((F.expr(value) >= F.lit(c)).cast("long")).alias(f"{rule}_{i}")
            for rule, (value, grid) in RULES.items() for i, c in enumerate(grid)]
    seen = made.where("not base_failed").join(good, "doc_id").groupBy("stratum").agg(F.count("*").alias("n"), *sums)
    held = {(r["stratum"], rule): (r["n"], [r[f"{rule}_{i}"] for i in range(len(grid))])
            for r in seen.collect() for rule, (_, grid) in RULES.items()}
    return certify(held, alpha, delta)


def judged(made: DataFrame, chosen: dict) -> DataFrame:
    """``made`` with ``kept``: neither the base test nor a certified rule of its stratum rejects the document."""
    limits = made.sparkSession.createDataFrame(
        [(s, *[float(chosen[s, r]) if (s, r) in chosen else None for r in RULES]) for s in sorted({s for s, _ in chosen})],
        "limit_stratum string, " + ", ".join(f"limit_{r} double" for r in RULES))
    made = made.join(checked(limits), F.col("stratum") == F.col("limit_stratum"), "left")
    rejected = F.col("base_failed")
    for rule, (value, _) in RULES.items():
        rejected |= F.coalesce(F.expr(value) >= F.col(f"limit_{rule}"), F.lit(False))
    return made.withColumn("kept", ~rejected)


def counted(docs: DataFrame, min_words: int, max_repeat_percent: int, *cols: str | None) -> DataFrame:
    made = counts(docs, *cols)
    return made.withColumn("base_failed", failed_base(
        F.col("n_words"), F.col("n_repeat_words"), min_words, max_repeat_percent))


def quality(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, min_words: int = 50,
            max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text",
            stratum_col: str | None = "lang") -> DataFrame:
    """A row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    ``labels`` (doc_id, quality) are the holdout: the rules and cutoffs above
    were set beforehand, so all labelled documents can test them.  Of those
    with quality 1 that the base test passes, each stratum counts how many a
    rule would reject at each cutoff (an aggregation over all documents, of
    which strata x rules x cutoffs sums reach the driver); :func:`certify`
    then picks, with probability 1 - ``delta`` for all strata together, cutoffs
    that reject at most ``alpha`` of a stratum's good documents.  Where too few
    are labelled nothing is certified and nothing rejected by that rule.

    Null text: no words, so base_failed.  Null stratum: a stratum of its own
    (with the empty string).  A label with a null id or quality is not used;
    an id labelled both ways counts as not good; repeated rows count each.
    No labels: only the base test.  An empty table gives none.
    """
    made = settle(counted(docs, min_words, max_repeat_percent, id_col, text_col, stratum_col))
    return judged(made, cutoffs(made, labels, alpha, delta)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def kept_documents(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.05, min_words: int = 50,
                   max_repeat_percent: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   stratum_col: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with all their columns, in a second pass without a shuffle."""
    made = settle(counted(docs, min_words, max_repeat_percent, id_col, text_col, stratum_col))
    chosen = cutoffs(made, labels, alpha, delta)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = byte_values(batch.column(names.index(text_col)))
            strata = batch.column(names.index(stratum_col)).cast(pa.string()).to_pylist() if stratum_col else ["all"] * len(texts)
            yield batch.filter(pa.array([keeps(text_counts(t or b""), s or "", chosen, min_words, max_repeat_percent)
                                         for t, s in zip(texts, strata)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keeps(found: tuple, stratum: str, chosen: dict, min_words: int, max_repeat_percent: int) -> bool:
    """The verdict of :func:`judged` on one document's counts."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = found
    if failed_base(n_words, n_repeat, min_words, max_repeat_percent):
        return False
    words = max(n_words, 1)
    values = {"symbols": n_symbols / words, "dup_lines": n_dup_lines, "repeats": n_repeat / words,
              "long_words": word_chars / words}
    return not any(v >= chosen[stratum, r] for r, v in values.items() if (stratum, r) in chosen)
