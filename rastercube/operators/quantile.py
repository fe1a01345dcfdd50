"""Exact grouped statistics whose percentiles never gather a group in one task.

Spark's ``percentile`` keeps a value -> count map per group and merges all of
one group's maps in a single task, so a group holding a third of the rows
(one acquisition date over a whole mosaic) would have to fit in one executor.
Here the same numbers -- count, mean, sample standard deviation and exact
percentiles with linear interpolation between the two closest ranks, equal to
``percentile(x, p)`` -- come from aggregations that Spark combines map-side:

1. One scan: ``groupBy(keys, bucket)`` where ``bucket`` is an order-preserving
   key of the value (sign, binary exponent and the top ``bits`` mantissa
   bits).  Per bucket: count, sum, central second moment, min and max.  The
   group's count, mean and variance are recombined from these partials
   (Chan et al. parallel variance), and a running count over the buckets of
   each group (bounded: at most ``2 * exponents * 2**bits`` rows per group)
   finds the bucket that holds each wanted rank.
2. While a chosen bucket still holds more than ``exact_rows`` rows, one more
   scan splits its value range into ``refine_buckets`` equal-width pieces
   (at most that many histogram rows per target).  With the defaults, a date
   of 3e12 rows needs one such round: ~6e9 rows in the chosen bucket become
   ~1e5 after it.
3. A last scan gathers the values inside each chosen range (at most
   ``exact_rows`` per target), sorts them and reads the value at the rank.

Target tables (at most four rows per group) are joined to the rows by the
group keys; they are broadcast only below ``broadcast_rows`` (counted
first).  The windowed histogram is small and reused, so it is persisted (a
lost block is recomputed from lineage); each refinement round is
checkpointed to the session's ``spark.checkpoint.dir`` so an iterative
lineage stays short.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rastercube.session import checkpoint_dir

MAX_BROADCAST_ROWS = 500_000  # target rows are ~50 bytes: at most ~25 MB broadcast


def _pow2(e: Column) -> Column:
    return F.pow(F.lit(2.0), e.cast("double"))


def _exponent(a: Column) -> Column:
    """floor(log2(a)) for a > 0, corrected for rounding in ``log2``."""
    e0 = F.floor(F.log2(a))
    p = _pow2(e0)
    return e0 - F.when(a < p, 1).otherwise(0) + F.when(a >= p * 2.0, 1).otherwise(0)


def bucket_key(v: Column, bits: int = 8) -> Column:
    """Order-preserving LONG bucket of a DOUBLE: sign, exponent, top mantissa bits.

    ``a < b`` implies ``key(a) <= key(b)``; each key covers one contiguous
    value interval; zero has key 0 and NULL/NaN have NULL.
    """
    a = F.abs(v)
    e = _exponent(a)
    mant = F.floor((a / _pow2(e) - 1.0) * float(1 << bits))
    pos = (e + 1100) * (1 << bits) + mant + 1
    top = (1 << 62)  # beyond every finite key
    return (
        F.when(v.isNull() | F.isnan(v), F.lit(None))
        .when(v == float("inf"), F.lit(top))
        .when(v == float("-inf"), F.lit(-top))
        .when(v > 0, pos)
        .when(v < 0, -pos)
        .otherwise(F.lit(0))
        .cast("long")
    )


def _sizes(state: DataFrame, is_big: Column) -> tuple[int, int]:
    """(targets still too big, targets not yet single-valued) in one action."""
    r = state.agg(
        F.count(F.when(is_big, 1)).alias("big"),
        F.count(F.when(F.col("lo") < F.col("hi"), 1)).alias("pending"),
    ).first()
    return int(r["big"]), int(r["pending"])


def _maybe_broadcast(df: DataFrame, n_rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= limit else df


def _joined(base: DataFrame, targets: DataFrame, keys: list[str], n_targets: int, limit: int) -> DataFrame:
    """Rows of ``base`` inside each target's [lo, hi] range (one row per match)."""
    t = targets.select(*[F.col(k).alias(f"_t_{k}") for k in keys], "k", "lo", "hi", "below")
    t = _maybe_broadcast(t, n_targets, limit)
    cond = reduce(lambda a, b: a & b, [base[k].eqNullSafe(t[f"_t_{k}"]) for k in keys])
    j = base.join(t, cond & (base["_v"] >= t["lo"]) & (base["_v"] <= t["hi"]), "inner")
    return j.drop(*[f"_t_{k}" for k in keys])


def grouped_summary(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: list[float],
    *,
    names: dict[str, str] | None = None,
    bits: int = 8,
    exact_rows: int = 1_000_000,
    refine_buckets: int = 65536,
    broadcast_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Per group: ``mean, std, n, p_<i>`` (names overridable via ``names``).

    ``n`` counts non-missing values; mean/std/percentiles skip NULL (and NaN).
    ``std`` is the sample standard deviation (NULL for fewer than two values).
    Groups whose values are all missing appear with ``n = 0`` and NULLs.
    The work runs when this is called (it is iterative); the small result is
    written below ``spark.checkpoint.dir`` and read back, so nothing stays
    cached.
    """
    names = dict(names or {})
    out_mean = names.get("mean", "mean")
    out_std = names.get("std", "std")
    out_n = names.get("n", "n")
    out_p = [names.get(f"p{i}", f"p{i}") for i in range(len(probs))]

    spark = df.sparkSession
    folder = checkpoint_dir(spark)
    if not keys:  # one global group: a constant key keeps every step a keyed join
        df = df.withColumn("_g", F.lit(0))
        return grouped_summary(
            df, ["_g"], value, probs, names=names, bits=bits, exact_rows=exact_rows,
            refine_buckets=refine_buckets, broadcast_rows=broadcast_rows,
        ).drop("_g")

    v = F.col(value).cast("double")
    base = df.select(*keys, F.when(~F.isnan(v), v).alias("_v"))

    # Pass 1: one scan, histogram + moment partials per (group, bucket).
    hist = (
        base.withColumn("_b", bucket_key(F.col("_v"), bits))
        .groupBy(*keys, "_b")
        .agg(
            F.count("_v").alias("c"),
            F.sum("_v").alias("s"),
            (F.var_pop("_v") * F.count("_v")).alias("m2"),
            F.min("_v").alias("lo"),
            F.max("_v").alias("hi"),
        )
    )

    # One window pass over the (bounded) histogram of each group gives the
    # group's count, mean and running count; the second moment follows from
    # the same partitioning without another exchange.
    wg = Window.partitionBy(*keys)
    wb = wg.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    n_g = F.sum("c").over(wg)
    mean_g = F.when(n_g > 0, F.sum("s").over(wg) / n_g.cast("double"))
    dev = F.when(
        F.col("c") > 0,
        F.coalesce(F.col("m2"), F.lit(0.0)) + F.col("c") * F.pow(F.col("s") / F.col("c").cast("double") - mean_g, 2),
    ).otherwise(F.lit(0.0))
    per = hist.select(
        *keys, "c", "lo", "hi",
        n_g.alias("_n"),
        mean_g.alias("_mean"),
        dev.alias("_dev"),
        F.coalesce(F.sum("c").over(wb), F.lit(0)).alias("_before"),
    ).persist(StorageLevel.MEMORY_AND_DISK)  # small and reused: group measures, targets

    # Ranks (0-based) needed by every probability: floor and ceil of p*(n-1);
    # each bucket emits the ranks that fall inside it (no join needed).
    pos_cols = [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    rank_arr = F.array_distinct(
        F.array(*[F.floor(c) for c in pos_cols], *[F.ceil(c) for c in pos_cols])
    )
    inside = F.filter(rank_arr, lambda k: (F.col("_before") <= k) & (k < F.col("_before") + F.col("c")))
    state = (
        per.filter(F.col("c") > 0)
        .select(*keys, F.explode(inside).alias("k"), "lo", "hi", F.col("_before").alias("below"), F.col("c").alias("cnt"))
    )

    # Refinement rounds for ranges that are still too big to resolve directly.
    nb = float(refine_buckets)
    is_big = (F.col("lo") < F.col("hi")) & (F.col("cnt") > exact_rows)
    while True:
        n_big, n_pending = _sizes(state, is_big)
        if n_big == 0:
            break
        big = state.filter(is_big)
        j = _joined(base, big, keys, n_big, broadcast_rows)
        b = F.least(
            F.floor((F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * nb),
            F.lit(refine_buckets - 1).cast("long"),
        )
        h = j.withColumn("_sb", b).groupBy(*keys, "k", "below", "_sb").agg(
            F.count("_v").alias("c"), F.min("_v").alias("lo2"), F.max("_v").alias("hi2")
        )
        wt = Window.partitionBy(*keys, "k").orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
        h = h.withColumn("_before", F.col("below") + F.coalesce(F.sum("c").over(wt), F.lit(0)))
        new = h.filter((F.col("_before") <= F.col("k")) & (F.col("k") < F.col("_before") + F.col("c"))).select(
            *keys,
            "k",
            F.col("lo2").alias("lo"),
            F.col("hi2").alias("hi"),
            F.col("_before").alias("below"),
            F.col("c").alias("cnt"),
        )
        keep = state.filter(~is_big)
        # a refine round is rare; checkpoint it so the loop's lineage stays short
        state = keep.unionByName(new).checkpoint(eager=True)

    # Final pass: each pending range holds at most ``exact_rows`` values, so
    # they are gathered per target, sorted, and the value at the rank read.
    pending = state.filter(F.col("lo") < F.col("hi"))
    resolved = state.filter(F.col("lo") == F.col("hi")).select(*keys, "k", F.col("lo").alias("val"))
    if n_pending:
        j = _joined(base, pending, keys, n_pending, broadcast_rows)
        picked = j.groupBy(*keys, "k", "below").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
        picked = picked.select(
            *keys, "k", F.element_at(F.col("_vs"), (F.col("k") - F.col("below") + 1).cast("int")).alias("val")
        )
        resolved = resolved.unionByName(picked)

    # The histogram rows (group measures, second-moment parts) and the rank
    # values meet in one aggregation per group (no join).
    null_d = F.lit(None).cast("double")
    null_l = F.lit(None).cast("long")
    both = per.select(*keys, "_n", "_mean", "_dev", null_l.alias("k"), null_d.alias("val")).unionByName(
        resolved.select(*keys, null_l.alias("_n"), null_d.alias("_mean"), null_d.alias("_dev"), F.col("k").cast("long").alias("k"), "val")
    )
    out = both.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        F.max("_mean").alias("_mean"),
        F.sum("_dev").alias("_m2"),
        F.map_from_entries(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "val")))).alias("_m"),
    )

    cols = [F.col(k) for k in keys]
    cols.append(F.col("_mean").alias(out_mean))
    cols.append(
        F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1).cast("double"))).alias(out_std)
    )
    for p, name in zip(probs, out_p):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo_k, hi_k = F.floor(pos), F.ceil(pos)
        lo_v = F.element_at(F.col("_m"), lo_k)
        hi_v = F.element_at(F.col("_m"), hi_k)
        interp = (hi_k.cast("double") - pos) * lo_v + (pos - lo_k.cast("double")) * hi_v
        cols.append(F.when(F.col("_n") > 0, F.when(lo_k == hi_k, lo_v).otherwise(interp)).alias(name))
    cols.append(F.col("_n").cast("long").alias(out_n))
    # The result has one row per group: settle it, release the intermediates.
    result = out.select(*cols)
    path = f"{folder}/summary-{uuid.uuid4().hex}"
    result.write.parquet(path)
    per.unpersist()
    return spark.read.schema(result.schema).parquet(path)
