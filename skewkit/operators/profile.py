"""Profiles that say when the skew-aware operators are needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Exact: Spark keeps one counter per distinct value, and distinct counts grow at most with the square root of the rows.
_MEDIAN = "percentile_disc(0.5) WITHIN GROUP (ORDER BY {})"


def key_distribution(df: DataFrame, key: str | Column, key_alias: str = "key") -> DataFrame:
    """Rows per key, share of all rows, and size relative to the median key.

    Columns: ``key_alias, n, share, ratio_to_median`` (n descending). The
    total and the median come from one uncorrelated scalar subquery over the
    per-key counts, so no global window collects all keys into one task.
    """
    k = F.col(key) if isinstance(key, str) else key
    counts = df.groupBy(k.alias(key_alias)).agg(F.count(F.lit(1)).alias("n"))
    stats = counts.select(F.struct(
        F.sum("n").alias("total"),
        F.expr(_MEDIAN.format("n")).alias("median"),
    )).scalar()
    return (
        counts.select(
            key_alias,
            "n",
            (F.col("n") / stats.getField("total")).alias("share"),
            (F.col("n") / stats.getField("median")).alias("ratio_to_median"),
        )
        .orderBy(F.col("n").desc(), F.col(key_alias).asc())
    )


def partition_balance(df: DataFrame) -> DataFrame:
    """Rows per physical partition of ``df`` (``partition_id, n_rows``).

    Uses ``spark_partition_id()`` inside the plan instead of collecting
    partitions; empty partitions produce no row.
    """
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def balance_summary(balance: DataFrame) -> DataFrame:
    """One row: partitions with rows, max, median, max/median, largest share."""
    return balance.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.max("n_rows").alias("max_rows"),
        F.expr(_MEDIAN.format("n_rows")).alias("median_rows"),
        (F.max("n_rows") / F.expr(_MEDIAN.format("n_rows"))).alias("max_to_median"),
        (F.max("n_rows") / F.sum("n_rows")).alias("largest_share"),
    )
