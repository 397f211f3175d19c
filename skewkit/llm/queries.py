"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skewkit.llm import (
    bpe,
    chaining,
    edit_counts,
    exact_dedup,
    langid,
    minhash,
    mixing,
    periodic_runs,
    personal_data,
    repeated_bytes,
    secret_novelty,
    sorted_passes,
    turn_repair,
)
from skewkit.llm.common import documents, ship


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.identify_documents(documents(spark, sf_dir))


def op2_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return chaining.repeated_passages(documents(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe.encode_documents(documents(spark, sf_dir))


def op4_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return repeated_bytes.remove_repeats(documents(spark, sf_dir), keep_bytes=False)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return personal_data.find_personal_data(documents(spark, sf_dir).select("doc_id", "text"))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after edits that its own row gives."""
    ship(spark)
    return edit_counts.count_edited(documents(spark, sf_dir), edit_counts.own_edits())


def op8_vector_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sorted_passes.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.near_duplicates(documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return periodic_runs.summarise(periodic_runs.periodic_runs(documents(spark, sf_dir), looped=True))


def op12_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_novelty.find_secrets(documents(spark, sf_dir))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return turn_repair.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_mixture": op1_language_mixture,
    "op2_chained_passages": op2_chained_passages,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_repeated_bytes": op4_repeated_bytes,
    "op5_source_mix": op5_source_mix,
    "op6_personal_data": op6_personal_data,
    "op7_edit_counts": op7_edit_counts,
    "op8_vector_passes": op8_vector_passes,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_prob_minhash": op10_prob_minhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_secret_novelty": op12_secret_novelty,
    "op13_turn_repair": op13_turn_repair,
}

SQL: dict[str, str] = {
    "op5_source_mix": r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5e0)
           / 4503599627370496.0e0 AS u
  FROM documents),
s AS (
  SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * 2.0e0 AS cap, SUM(source_size) OVER () * 1.5e0 AS total,
         COALESCE(SUM(source_size * 2.0e0) OVER o, 0) AS below, SUM(w) OVER r AS open_w
  FROM s
  WINDOW o AS (ORDER BY source_size * 2.0e0 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         r AS (ORDER BY source_size * 2.0e0 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lv AS (SELECT COALESCE(MAX((total - below) / open_w) FILTER (WHERE cap > w * ((total - below) / open_w)), 0) AS level FROM f),
t AS (SELECT source, source_size, LEAST(source_size * 2.0e0, w * level) AS target FROM s, lv),
r AS (
  SELECT d.*, ROW_NUMBER() OVER () AS rid, t.source_size, t.target,
         CASE WHEN size > 0 THEN LEAST(t.target / t.source_size, 2.0e0) ELSE 0.0e0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, CAST(floor(rate) AS BIGINT) AS whole, rate - floor(rate) AS p,
         target - SUM(CAST(floor(rate) AS BIGINT) * size) OVER (PARTITION BY source) AS left0
  FROM r),
a AS (
  SELECT *, CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS k FROM q),
p1 AS (
  SELECT *, k IS NOT NULL AND SUM(size) OVER (PARTITION BY source, k IS NULL ORDER BY k, doc_id, size
                                              ROWS UNBOUNDED PRECEDING) <= left0 AS t1 FROM a),
g1 AS (SELECT *, left0 - SUM(CASE WHEN t1 THEN size ELSE 0 END) OVER (PARTITION BY source) AS left1 FROM p1),
o1 AS (SELECT *, k IS NOT NULL AND NOT t1 AND size <= left1 AS open1 FROM g1),
p2 AS (
  SELECT *, open1 AND SUM(size) OVER (PARTITION BY source, open1 ORDER BY k, doc_id, size
                                      ROWS UNBOUNDED PRECEDING) <= left1 AS t2 FROM o1),
g2 AS (SELECT *, left1 - SUM(CASE WHEN t2 THEN size ELSE 0 END) OVER (PARTITION BY source) AS left2 FROM p2),
o2 AS (SELECT *, open1 AND NOT t2 AND size <= left2 AS open2 FROM g2),
p3 AS (
  SELECT *, open2 AND SUM(size) OVER (PARTITION BY source, open2 ORDER BY k, doc_id, size
                                      ROWS UNBOUNDED PRECEDING) <= left2 AS t3 FROM o2),
g3 AS (SELECT *, left2 - SUM(CASE WHEN t3 THEN size ELSE 0 END) OVER (PARTITION BY source) AS left3 FROM p3),
o3 AS (SELECT *, k IS NOT NULL AND NOT t1 AND NOT t2 AND NOT t3 AND size < 2 * left3 AS open3 FROM g3),
p4 AS (SELECT *, open3 AND ROW_NUMBER() OVER (PARTITION BY source, open3 ORDER BY k, doc_id, size) = 1 AS t4 FROM o3)
SELECT doc_id, size, source_size, target,
       CAST((whole + CAST(t1 OR t2 OR t3 OR t4 AS BIGINT)) * size AS BIGINT) AS taken
FROM p4""",
    "op9_exact_dedup": """
SELECT doc_id, MAX(doc_id) OVER w AS keep_id, COUNT(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM MAX(doc_id) OVER w AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY COALESCE(text, ''))""",
}
