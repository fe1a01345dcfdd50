"""Registered queries of the operators, with production parameters, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastercube.llm import (
    collocation, exact_dedup, html_text, lm_scoring, merkle, minhash_forest, mixing, packing, quality, sharding, simhash, substring, warc)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).accounts().drop("source")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_table(spark, sf_dir, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op11_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"), words=5, percent=85)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(_table(spark, sf_dir, "documents"), least=30, share=80, top=2000)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_leaves(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_lm_scoring, op3_simhash, op4_mixing, op5_html_text, op6_warc, op7_exact_dedup,
        op8_quality_rules, op9_substring_dedup, op10_sharding, op11_minhash_forest,
        op12_collocations, op13_merkle_manifest)}

ORACLE: dict[str, str] = {
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
                          CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS original FROM p)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN original > page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original > page_id THEN original END AS refers_to
        FROM d""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op9_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             k AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
                   FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d)),
             s AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h) AS n FROM k) WHERE n > 1),
             c AS (SELECT DISTINCT r, i + j AS p FROM s, (SELECT unnest(range(0, 35)) AS j)),
             m AS (SELECT r, list(p) AS gone FROM c GROUP BY r),
             t AS (SELECT doc_id, len(w) AS n, w, gone FROM d LEFT JOIN m USING (r)),
             x AS (SELECT doc_id, n, CASE WHEN gone IS NULL THEN w
                          ELSE list_transform(list_filter(range(1, n + 1), lambda p: NOT list_contains(gone, p)),
                                              lambda p: w[p]) END AS kept FROM t)
        SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
               sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM x""",
    "op12_collocations": collocation.oracle_sql(),
    "op13_merkle_manifest": merkle.oracle_sql(),
}
