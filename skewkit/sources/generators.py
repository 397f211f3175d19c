"""Seeded, distributed generators of the skewed retail star (B2).

Rows come from ``spark.range`` split over ``num_partitions`` tasks; every
random choice is a hash of (seed, row id, purpose), so the same parameters
give the same rows on every run and on every task retry, at any scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.expressions import hash_uniform

# --- Fixed values: shape of the reference data set. -------------------------
# Product key shares of sales (80 / 18 / 1.9 / 0.1 %), the four sold products
# (id, name, category), the 70 / 30 split over two sale dates, and customer
# regions with 30 % NULL. Product ids are the skew labels of FIXTURES.md.
PRODUCT_SHARES = (
    ("PROMO_ESPECIAL", 0.80),
    ("PRODUTO_A", 0.18),
    ("PRODUTO_B", 0.019),
    ("PRODUTO_C", 0.001),
)
# Names and categories of the sold products follow from their position.
SOLD_PRODUCTS = tuple((key, f"Item {i}", f"Category {i}") for i, (key, _) in enumerate(PRODUCT_SHARES, 1))
FILLER_CATEGORY = "Other"
DATE_SHARES = (("2024-01-01", 0.70), ("2024-01-02", 0.30))
REGION_SHARES = ((None, 0.30), ("SP", 0.35), ("RJ", 0.245), ("MG", 0.105))


def pick(u: Column, choices: Sequence[tuple[object, float]]) -> Column:
    """Choose a value by cumulative share from a uniform ``u`` in [0, 1)."""
    total = sum(s for _, s in choices)
    expr = None
    acc = 0.0
    for value, share in choices[:-1]:
        acc += share / total
        lit = F.lit(value) if value is not None else F.lit(None).cast("string")
        expr = F.when(u < acc, lit) if expr is None else expr.when(u < acc, lit)
    last = choices[-1][0]
    last_lit = F.lit(last) if last is not None else F.lit(None).cast("string")
    return last_lit if expr is None else expr.otherwise(last_lit)


def generate_sales(spark: SparkSession, rows: int, num_partitions: int = 8, seed: int = 42,
                   product_shares: Sequence[tuple[str, float]] = PRODUCT_SHARES,
                   date_shares: Sequence[tuple[str, float]] = DATE_SHARES) -> DataFrame:
    """``sale_id, product_id, amount, quantity, sale_date`` with skewed keys."""
    ids = spark.range(0, rows, 1, num_partitions)
    return ids.select(
        F.col("id").alias("sale_id"),
        pick(hash_uniform("id", F.lit("product"), seed=seed), product_shares).alias("product_id"),
        (hash_uniform("id", F.lit("amount"), seed=seed) * 1000).alias("amount"),
        (hash_uniform("id", F.lit("quantity"), seed=seed) * 100).cast("int").alias("quantity"),
        F.to_date(pick(hash_uniform("id", F.lit("date"), seed=seed), date_shares)).alias("sale_date"),
    )


def generate_products(spark: SparkSession, rows: int = 1000, num_partitions: int = 1,
                      sold: Sequence[tuple[str, str, str]] = SOLD_PRODUCTS) -> DataFrame:
    """The sold products plus filler rows up to ``rows`` (unique ids, never sold)."""
    named = spark.createDataFrame(list(sold), "product_id string, product_name string, category string")
    fill = max(0, rows - len(sold))
    filler = spark.range(0, fill, 1, num_partitions).select(
        F.format_string("PROD_%04d", F.col("id")).alias("product_id"),
        F.format_string("Product %d", F.col("id")).alias("product_name"),
        F.lit(FILLER_CATEGORY).alias("category"),
    )
    return named.unionByName(filler)


def generate_customers(spark: SparkSession, rows: int, num_partitions: int = 8, seed: int = 42,
                       region_shares: Sequence[tuple[str | None, float]] = REGION_SHARES) -> DataFrame:
    """``customer_id, region (nullable), monthly_income``."""
    ids = spark.range(0, rows, 1, num_partitions)
    return ids.select(
        F.col("id").alias("customer_id"),
        pick(hash_uniform("id", F.lit("region"), seed=seed), region_shares).alias("region"),
        (hash_uniform("id", F.lit("income"), seed=seed) * 50000 + 1000).alias("monthly_income"),
    )


def skew_rekey(df: DataFrame, id_cols: Sequence[str], seed: int = 42,
               shares: Sequence[tuple[str, float]] = PRODUCT_SHARES, alias: str = "product_id") -> DataFrame:
    """Add a skewed key column to an existing table from a hash of its id columns.

    Turns a uniform table (e.g. the driver's lineitem) into a skewed one
    whose size grows with the input.
    """
    return df.withColumn(alias, pick(hash_uniform(*id_cols, F.lit("product"), seed=seed), shares))
