"""The five NDVI measures by date (or any grouping): mean, std, p25, p75, count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastercube.operators.quantile import grouped_summary

PROBS = (0.25, 0.75)
# ``auto``: groups of at most so many rows, by count, are summarised in one pass.  Spark holds up to 128 groups'
# values in a task before it sorts: at about 100 bytes each, some 250 MB.
ONE_PASS_ROWS = 20_000


def five_measures(
    df: DataFrame,
    keys: list[str],
    value: str = "ndvi",
    prefix: str = "ndvi",
    method: str = "exact",
    **kwargs,
) -> DataFrame:
    """``keys + {prefix}_mean, _std, _p25, _p75, pixel_count``.

    method:
      ``exact``   distributed exact percentiles (default; no group ever sits
                  whole in one task, see ``operators.quantile``).  It reads
                  ``df`` twice (column-pruned), so give it a stored or
                  persisted table -- the job reads the observation store --
                  rather than an expensive source such as the tile decoder
      ``builtin`` Spark's ``percentile``: one pass, but each group's distinct
                  values are merged in a single task -- only for groups of a
                  known, bounded size
      ``approx``  ``percentile_approx`` (bounded sketch, approximate)
      ``auto``    the exact numbers, by ``builtin`` if no group has more than
                  ``one_pass_rows`` rows (they are counted first), else by
                  ``exact``

    NULL and NaN count as missing.
    """
    names = {
        "mean": f"{prefix}_mean",
        "std": f"{prefix}_std",
        "p0": f"{prefix}_p25",
        "p1": f"{prefix}_p75",
        "n": "pixel_count",
    }
    if method == "auto":
        limit = kwargs.pop("one_pass_rows", ONE_PASS_ROWS)
        largest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        method = "builtin" if largest <= limit else "exact"
    if method == "exact":
        out = grouped_summary(df, keys, value, list(PROBS), names=names, **kwargs)
        return out.select(*keys, *[names[k] for k in ("mean", "std", "p0", "p1", "n")])
    v = F.when(~F.isnan(value), F.col(value))
    if method == "builtin":
        pct = F.percentile(v, F.array(*[F.lit(p) for p in PROBS]))
    elif method == "approx":
        pct = F.percentile_approx(v.cast("double"), list(PROBS), kwargs.get("accuracy", 10000))
    else:
        raise ValueError(f"unknown method {method!r}")
    agg = df.groupBy(*keys).agg(
        F.mean(v).alias(names["mean"]),
        F.stddev_samp(v).alias(names["std"]),
        pct.alias("_pct"),
        F.count(v).alias(names["n"]),
    )
    return agg.select(
        *keys,
        names["mean"],
        names["std"],
        F.col("_pct")[0].cast("double").alias(names["p0"]),
        F.col("_pct")[1].cast("double").alias(names["p1"]),
        names["n"],
    )


def date_stats(obs: DataFrame, method: str = "exact", **kwargs) -> DataFrame:
    """Per-date statistics ordered by date."""
    return five_measures(obs.select("date", "ndvi"), ["date"], method=method, **kwargs).orderBy("date")


def observation_count(obs: DataFrame) -> DataFrame:
    """Total number of observations as a one-row table."""
    return obs.agg(F.count(F.lit(1)).alias("n_obs"))
