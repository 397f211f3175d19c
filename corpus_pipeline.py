"""A training corpus from raw documents: five stages, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of their input, those
of ``documents``. Rows that share a doc_id share the decisions of a stage.
An empty input gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.llm import bpe, exact_dedup, langid, minhash, mixing
from skewkit.llm.common import documents, ship
from skewkit.session import materialize


def _matching(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` joined to a table of distinct ids; null ids match each other."""
    there = ids.withColumnRenamed("doc_id", "_id")
    return docs.join(there, docs["doc_id"].eqNullSafe(there["_id"]), how)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents with no language (a null text, or not one letter) go."""
    ship(spark)
    # columns under names of their own, so that none of the input's is taken for a prediction
    own = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    known = langid.identify(docs.withColumnsRenamed(own), langid.fit_documents(docs), text_col=own["text"]).where(
        F.col("lang_pred") != langid.UNDETERMINED)
    return known.select(*[F.col(new).alias(old) for old, new in own.items()])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the largest doc_id stays, once."""
    ship(spark)
    kept = materialize(exact_dedup.exact_duplicates(docs).where("kept").select("doc_id", "text_sha256"), "kept-ids")
    once = materialize(kept.distinct(), "kept-once")
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    there = once.withColumnRenamed("doc_id", "_id")
    out = docs.join(there, docs["doc_id"].eqNullSafe(there["_id"]) & (sha == there["text_sha256"]), "left_semi")
    return out if kept.count() == once.count() else out.dropDuplicates(["doc_id", "text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each class stays, the one with the smallest doc_id."""
    ship(spark)
    kept = minhash.near_duplicates(docs).where("kept").select("doc_id").distinct()
    return _matching(docs, kept, "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: each document appears as often as the mix takes it."""
    copies = mixing.mix(docs).where("copies > 0").groupBy("doc_id").agg(F.max("copies").cast("int").alias("_copies"))
    out = _matching(docs, copies, "inner")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).select(*docs.columns)


def encode_corpus(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    ship(spark)
    return bpe.encode_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_corpus),
]

#: Language mixtures, signatures and BPE are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is a table in the shared folder that the next one reads."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
