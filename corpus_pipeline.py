"""A training-data pipeline over ``documents``: quality rules, exact and near deduplication, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last return the columns of documents.  ``run`` does
that for the whole table; the intermediate tables lie in the folder of
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.llm import exact_dedup, mixing, packing, quality, simhash
from rastercube.llm.common import checked, settle
from rastercube.llm.queries import tokenizer_path

# Quality rules need exact binomial bounds and packing a tokenizer, which SQL does not have; see tests/llm.
ORACLE_SQL = None


def apply_decisions(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the rows that are to go.

    ``decided`` has (doc_id, text_sha256, once): rows of a listed key go, or
    if ``once`` is true all but one of them.  Documents that are not listed
    stay and are not moved, as long as the listed ones are few enough to be
    broadcast (by count); beyond that both sides are shuffled.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.col("doc_id").cast("long").alias("id"),
        F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("mark"))
    decided = checked(settle(decided))
    rows = rows.join(decided, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("text_sha256")), "left")
    kept = rows.where("once is null").select("doc.*")
    if decided.where("once").limit(1).count():
        kept = kept.union(rows.where("once").dropDuplicates(["id", "mark"]).select("doc.*"))
    return kept


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and the certified rules of their language.

    A null or empty text has no words and fails the base test; a null language
    is a stratum of its own; whole texts are read, however long; repeated rows
    are judged alike and keep their number; an empty table stays empty.
    """
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, that of the largest doc_id.

    Null counts as empty text; a null doc_id is the smallest; of repeated rows
    one stays; long texts are compared by all their chunks; an empty table
    stays empty.
    """
    found = exact_dedup.exact_duplicates(docs).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("any"), F.count("*").alias("n"))
    return apply_decisions(docs, found.where("not any or n > 1").select("doc_id", "text_sha256", F.col("any").alias("once")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id (of several texts with it, the one of least digest)."""
    found = settle(simhash.near_duplicates(docs, words=4, max_bits=4))
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    others = found.where(~first).select("doc_id", "text_sha256").distinct().withColumn("once", F.lit(False))
    several = settle(found.where(first).groupBy("root").agg(
        F.count("*").alias("n"), F.min("text_sha256").alias("least")).where("n > 1"))
    ties = found.where(first).join(checked(several), "root").select(
        "doc_id", "text_sha256", (F.col("text_sha256") == F.col("least")).alias("once")).distinct()
    return apply_decisions(docs, others.unionByName(ties))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken, shard by shard.

    A null text has size 0 and comes as it is or not at all; a null source is
    a source of its own, the last; repeated rows are documents of their own; an
    empty table stays empty.
    """
    return mixing.mix(docs, weights=(5, 2, 1), share=1.5, most=2.0).documents()


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2,048 ids.

    A null or empty text is the end id alone, a null doc_id stays null, a long
    text fills windows of its own, repeated rows are packed once each, and an
    empty table gives no rows.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality rules", quality_rules), ("exact dedup", exact), ("simhash near-dedup", near),
          ("mixing", mixed), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
