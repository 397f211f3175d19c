"""The retail star (sales, products, customers) mapped onto the driver tables.

fact ``sales``      <- lineitem: l_orderkey sale, l_partkey product,
                       l_extendedprice amount, l_quantity quantity (INT),
                       l_shipdate date, l_returnflag flag
dimension products  <- part: p_partkey product, p_name name, p_type category
customers           <- customer: c_custkey customer, region = c_mktsegment
                       with about 30 % NULL (derived from the key)

Each reader projects only the columns it maps, so the scans' ReadSchema
holds just those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.expressions import hot_product_sql, money_sum, null_region, quantity_int, skew_key
from skewkit.sources.tables import read_table


def sales(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem",
                    ["l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag"])
    return li.select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("amount"),
        quantity_int("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("sale_ts"),
        F.col("l_returnflag").alias("flag"),
    )


def skewed_sales(spark: SparkSession, base: str) -> DataFrame:
    """Sales with the derived skewed key ``skew_key`` (80 / 18 / 1.8 / 0.2 %)."""
    return sales(spark, base).withColumn("skew_key", skew_key("sale_id"))


def hot_product_sales(spark: SparkSession, base: str) -> DataFrame:
    """Sales of which one product has about 80 % and the others keep theirs: a skewed key with many values."""
    return sales(spark, base).withColumn("product_id", F.expr(hot_product_sql("sale_id", "product_id")))


def products(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "part", ["p_partkey", "p_name", "p_type"]).select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def customers(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "customer", ["c_custkey", "c_mktsegment"]).select(
        F.col("c_custkey").alias("customer_id"),
        null_region("c_custkey", "c_mktsegment").alias("region"),
    )


def order_labels(spark: SparkSession, base: str) -> DataFrame:
    """Orders per skew label: ``skew_key, n_orders, order_total`` (a small side)."""
    o = read_table(spark, base, "orders", ["o_orderkey", "o_totalprice"])
    return o.groupBy(skew_key("o_orderkey").alias("skew_key")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        money_sum("o_totalprice").alias("order_total"),
    )
