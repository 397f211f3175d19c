"""Composed retail queries over the driver tables, each with its DuckDB oracle.

Every callable takes ``(spark, base_dir)`` and returns a DataFrame; the
``SQL`` dict holds the equivalent ANSI SQL over the driver's views. Output
column names are equal on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.expressions import (
    SKEW_LABELS,
    cents,
    cents_to_money,
    money_sum,
    money_sum_sql,
    null_region_sql,
    salt_bucket,
    skew_key_sql,
)
from skewkit.operators.aggregates import (
    Agg,
    aggregate_before_join,
    count_by,
    group_aggregate,
    hot_groups,
    salted_aggregate,
)
from skewkit.operators.joins import (
    PARTS_PER_TASK,
    broadcast_join,
    guarded_cross_join,
    join_fanout,
    left_outer_join,
    salted_join,
    shuffle_join,
)
from skewkit.operators.ordering import ranked, sort_within_partitions, top_k
from skewkit.operators.profile import key_distribution, partition_balance
from skewkit.operators.reuse import multi_analysis, tagged_union
from skewkit.plans import star
from skewkit.session import materialize, scratch_path, shuffle_partitions
from skewkit.sinks.writers import sized_write, write_parquet
from skewkit.sources.files import file_census
from skewkit.sources.generators import skew_rekey
from skewkit.sources.tables import read_table, table_path

UNKNOWN_REGION = "UNKNOWN"
TOP_K = 5

SUMMARY_AGGS = (
    Agg("money", "amount", "total_amount"),
    Agg("count", "sale_id", "n_sales"),
    Agg("avg", "quantity", "avg_quantity"),
)
SKEW_AGGS = (Agg("money", "amount", "total_amount"), Agg("count", "*", "n_sales"))

SKEW = skew_key_sql("l_orderkey")
MONEY_PRICE = money_sum_sql("l_extendedprice")


# --- B1 scan ---------------------------------------------------------------

def scan_sales(spark: SparkSession, base: str) -> DataFrame:
    return star.sales(spark, base).select(
        "sale_id", "product_id", "amount", "quantity", F.to_date("sale_ts").alias("sale_date"), "flag"
    )


# --- B6 flagship, B5 / B4 joins ---------------------------------------------

def sales_summary(spark: SparkSession, base: str) -> DataFrame:
    """Per (product, category, flag): exact total, number of sales, mean quantity.

    Sales are reduced per (product, flag) before the size-checked broadcast
    join with products, then merged per (product, category, flag).
    """
    return aggregate_before_join(star.sales(spark, base), star.products(spark, base), "product_id",
                                 ["flag"], ["category"], SUMMARY_AGGS)


def _category_totals(joined: DataFrame) -> DataFrame:
    return group_aggregate(joined, ["category"], (Agg("money", "amount", "total_amount"),
                                                   Agg("count", "sale_id", "n_sales")))


def sales_summary_by_date(spark: SparkSession, base: str) -> DataFrame:
    """Per (product, category, date), the flagship's own grouping."""
    dated = star.sales(spark, base).withColumn("sale_date", F.to_date("sale_ts"))
    return aggregate_before_join(dated, star.products(spark, base), "product_id", ["sale_date"], ["category"], SUMMARY_AGGS)


def _skewed_products(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The skewed fact and its products: one row per skew key, with the key's category."""
    fact = star.skewed_sales(spark, base).select("sale_id", "skew_key", "amount", "sale_ts")
    return fact, fact.select("skew_key").distinct().withColumn("category", F.substring_index("skew_key", "_", 1))


def category_product_totals(spark: SparkSession, base: str) -> DataFrame:
    """Per (category, product) after the product join on the skewed fact."""
    fact, products = _skewed_products(spark, base)
    return group_aggregate(broadcast_join(fact, materialize(products, "skewed-products"), "skew_key"), ["category", "skew_key"], SKEW_AGGS)


def category_product_totals_salted(spark: SparkSession, base: str) -> DataFrame:
    """The same by a salted join and a salted two-stage aggregate of the hot groups."""
    fact, products = _skewed_products(spark, base)
    joined = salted_join(fact, materialize(products, "skewed-products"), "skew_key", broadcast_max_rows=0)
    keys = ["category", "skew_key"]
    return salted_aggregate(joined, keys, SKEW_AGGS, hot=hot_groups(joined, keys), salt_cols=["sale_id", "amount", "sale_ts"])


def broadcast_join_agg(spark: SparkSession, base: str) -> DataFrame:
    return _category_totals(broadcast_join(star.sales(spark, base), star.products(spark, base), "product_id"))


def shuffle_join_agg(spark: SparkSession, base: str) -> DataFrame:
    return _category_totals(shuffle_join(star.sales(spark, base), star.products(spark, base), "product_id"))


# --- B3 write and read back ---------------------------------------------------

def write_read_back(spark: SparkSession, base: str) -> DataFrame:
    """The flagship result written as Parquet to the shared scratch folder and read back."""
    path = write_parquet(sales_summary(spark, base), scratch_path(spark, "sales_summary"))
    return spark.read.parquet(path)


# --- Row counts of the given tables ----------------------------------------

COUNTED_TABLES = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events",
                  "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_counts(spark: SparkSession, base: str) -> DataFrame:
    """Rows per table; each count reads no column data (row-group metadata only)."""
    parts = [spark.read.parquet(table_path(base, t)).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in COUNTED_TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unhinted_join_agg(spark: SparkSession, base: str) -> DataFrame:
    """The category totals with no hint: the planner and AQE pick the join."""
    return _category_totals(star.sales(spark, base).join(star.products(spark, base), "product_id"))


# --- B15 / B16 ordering -----------------------------------------------------

def category_ranked(spark: SparkSession, base: str) -> DataFrame:
    return ranked(broadcast_join_agg(spark, base), ["total_amount"], ["category"])


def top_products(spark: SparkSession, base: str) -> DataFrame:
    totals = aggregate_before_join(star.sales(spark, base), star.products(spark, base), "product_id",
                                   [], ["product_name"], (Agg("money", "amount", "total_amount"),))
    return top_k(totals, TOP_K, ["total_amount"], ["product_id"])


# --- B13 NULL keys, B12 left outer, B14 cross summary ----------------------

def region_counts(spark: SparkSession, base: str) -> DataFrame:
    return count_by(star.customers(spark, base), "region", "customer_id", "n_customers", UNKNOWN_REGION)


def left_outer_summary(spark: SparkSession, base: str) -> DataFrame:
    """Flag counts left-joined to segment counts on flag = segment (keys never match)."""
    flags = star.sales(spark, base).groupBy("flag").agg(F.count(F.lit(1)).alias("n_lines"))
    segments = (read_table(spark, base, "customer", ["c_mktsegment"])
                .groupBy(F.col("c_mktsegment").alias("segment"))
                .agg(F.count(F.lit(1)).alias("n_customers")))
    return left_outer_join(flags, segments, "flag", "segment")


def null_key_left_join(spark: SparkSession, base: str) -> DataFrame:
    """Customers (about 30 % NULL region) left-joined to segment counts.

    NULL keys never match, so their rows keep NULL right columns; an inner
    join would drop them.
    """
    segments = (read_table(spark, base, "customer", ["c_mktsegment"])
                .groupBy(F.col("c_mktsegment").alias("region")).agg(F.count(F.lit(1)).alias("segment_size")))
    joined = left_outer_join(star.customers(spark, base), segments, "region")
    return (joined.fillna({"region": UNKNOWN_REGION})
            .groupBy("region")
            .agg(F.count(F.lit(1)).alias("n_customers"), F.count("segment_size").alias("n_matched")))


def cross_summary(spark: SparkSession, base: str) -> DataFrame:
    """Category totals next to every region count (right side capped and broadcast)."""
    return guarded_cross_join(broadcast_join_agg(spark, base), region_counts(spark, base))


# --- B8 profile, B7 / B10 skewed aggregates -------------------------------

def skew_profile(spark: SparkSession, base: str) -> DataFrame:
    return key_distribution(star.skewed_sales(spark, base), "skew_key", "skew_key")


def skewed_agg(spark: SparkSession, base: str) -> DataFrame:
    return group_aggregate(star.skewed_sales(spark, base), ["skew_key", "flag"], SKEW_AGGS)


def salted_agg(spark: SparkSession, base: str) -> DataFrame:
    return salted_aggregate(star.skewed_sales(spark, base), ["skew_key", "flag"], SKEW_AGGS,
                            salt_cols=["sale_id", "product_id", "amount", "sale_ts"])


def salted_agg_hot(spark: SparkSession, base: str) -> DataFrame:
    """The same aggregate with only the groups above a mean task split."""
    s, keys = star.skewed_sales(spark, base), ["skew_key", "flag"]
    return salted_aggregate(s, keys, SKEW_AGGS, hot=hot_groups(s, keys),
                            salt_cols=["sale_id", "product_id", "amount", "sale_ts"])


# --- B11 salted join, B9 fan-out --------------------------------------------

def _salted_join_summary(joined: DataFrame) -> DataFrame:
    return joined.groupBy("skew_key", "flag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        money_sum("amount").alias("total_amount"),
        F.sum(F.col("n_orders").cast("decimal(28,0)")).cast("decimal(38,0)").alias("order_lines"),
        F.max("order_total").alias("order_total"),
    )


def salted_join_q(spark: SparkSession, base: str) -> DataFrame:
    fact = star.skewed_sales(spark, base).select("sale_id", "skew_key", "flag", "amount", "sale_ts")
    joined = salted_join(fact, star.order_labels(spark, base), "skew_key", "inner")
    return _salted_join_summary(joined)


def salted_inner_join_q(spark: SparkSession, base: str) -> DataFrame:
    """The inner join by its salted path, which a side beyond the broadcast bound takes."""
    fact = star.skewed_sales(spark, base).select("sale_id", "skew_key", "flag", "amount", "sale_ts")
    return _salted_join_summary(salted_join(fact, star.order_labels(spark, base), "skew_key", "inner", broadcast_max_rows=0))


def salted_left_join_q(spark: SparkSession, base: str) -> DataFrame:
    """Left variant: one label is missing on the right.

    Runs the salted shuffle path on purpose (``broadcast_max_rows=0``), the
    path taken when the right side is beyond the broadcast bound, so that the
    salting itself stays under the oracle check; ``salted_join`` shows the
    default, which broadcasts this small side.
    """
    fact = star.skewed_sales(spark, base).select("sale_id", "skew_key", "flag", "amount", "sale_ts")
    labels = star.order_labels(spark, base).where(F.col("skew_key") != SKEW_LABELS[-1])
    joined = salted_join(fact, labels, "skew_key", "left", broadcast_max_rows=0)
    return _salted_join_summary(joined)


def join_fanout_q(spark: SparkSession, base: str) -> DataFrame:
    orders = read_table(spark, base, "orders", ["o_orderkey"]).select(
        F.expr(skew_key_sql("o_orderkey")).alias("skew_key"))
    return join_fanout(star.skewed_sales(spark, base), orders, "skew_key", "skew_key", "skew_key")


# --- B18 partition balance, B19 file census, B2 skew injection -------------

def partition_balance_scan(spark: SparkSession, base: str) -> DataFrame:
    """Rows of the sales scan, summed from its physical partitions as Spark splits the files."""
    return partition_balance(star.sales(spark, base)).agg(F.sum("n_rows").alias("n_rows"))


def partition_balance_salted(spark: SparkSession, base: str) -> DataFrame:
    """Rows per key after a real exchange on (key, salt), summed from its partitions: no partition holds a whole hot key."""
    n = PARTS_PER_TASK * shuffle_partitions(spark)
    s = star.skewed_sales(spark, base)
    salted = s.withColumn("_salt", salt_bucket(n, "sale_id", "product_id", "amount", "sale_ts"))
    parts = salted.select("skew_key", "_salt").repartition("skew_key", "_salt").groupBy(
        "skew_key", F.spark_partition_id().alias("partition_id")).agg(F.count(F.lit(1)).alias("n_rows"))
    return parts.groupBy("skew_key").agg(F.sum("n_rows").alias("n_rows"))


def file_census_q(spark: SparkSession, base: str) -> DataFrame:
    """Files, bytes and small files per directory of the given tables."""
    return file_census(spark, base)


def generated_skew_profile(spark: SparkSession, base: str) -> DataFrame:
    """lineitem re-keyed with the generator's product shares, profiled per key."""
    li = read_table(spark, base, "lineitem", ["l_orderkey", "l_linenumber"])
    return key_distribution(skew_rekey(li, ["l_orderkey", "l_linenumber"]), "product_id", "product_id")


# --- B17 partition-local sort -----------------------------------------------

def sorted_within_partitions(spark: SparkSession, base: str) -> DataFrame:
    s = star.sales(spark, base).select("sale_id", "product_id", "flag", "amount")
    return sort_within_partitions(s, ["flag", "amount"])


# --- B20 sized write, B21 multi analysis ------------------------------------

def category_date_totals(spark: SparkSession, base: str) -> DataFrame:
    joined = broadcast_join(star.sales(spark, base), star.products(spark, base), "product_id")
    return group_aggregate(joined.withColumn("sale_date", F.to_date("sale_ts")), ["category", "sale_date"],
                           (Agg("money", "amount", "total_amount"), Agg("count", "sale_id", "n_sales")))


def compacted_write(spark: SparkSession, base: str) -> DataFrame:
    """(category, date) totals written in size-targeted files, then read back."""
    path = scratch_path(spark, "category_date")
    sized_write(category_date_totals(spark, base), path, cluster_by=["category", "sale_date"])
    return spark.read.parquet(path)


MULTI_COLUMNS = {
    "category": "string", "sale_date": "date", "product_id": "bigint", "product_name": "string",
    "total_amount": "double", "n_sales": "bigint",
}


def _product_and_day_states(spark: SparkSession, base: str) -> DataFrame:
    """One scan of the sales reduced by two grouping sets, per product and per date, to mergeable states."""
    dated = star.sales(spark, base).withColumn("sale_date", F.to_date("sale_ts"))
    return dated.groupingSets([["product_id"], ["sale_date"]], "product_id", "sale_date").agg(
        F.sum(cents("amount")).alias("_cents"), F.count("sale_id").alias("_n"), F.grouping("product_id").alias("_by_date"))


def _analyses(products: DataFrame) -> list:
    """By category and by product after the join with products; by date over all sales, joined or not."""
    def joined(d: DataFrame) -> DataFrame:
        return broadcast_join(d.where("_by_date = 0").drop("sale_date"), products, "product_id")

    total, n = cents_to_money(F.sum("_cents")).alias("total_amount"), F.sum("_n").alias("n_sales")
    return [
        ("by_category", lambda d: joined(d).groupBy("category").agg(total, n)),
        ("by_date", lambda d: d.where("_by_date = 1").select("sale_date", F.col("_n").alias("n_sales"))),
        ("by_product", lambda d: joined(d).groupBy("product_id", "product_name").agg(total)),
    ]


def multi_analysis_q(spark: SparkSession, base: str) -> DataFrame:
    """Three analyses of one persisted table, the states of one scan per product and per date; the fact is not cached."""
    return multi_analysis(_product_and_day_states(spark, base), _analyses(star.products(spark, base)), MULTI_COLUMNS)


def multi_analysis_single_pass(spark: SparkSession, base: str) -> DataFrame:
    """The same three analyses over the states as a written table: one scan of the fact, nothing cached."""
    return tagged_union(materialize(_product_and_day_states(spark, base), "product-and-day-states"),
                        _analyses(star.products(spark, base)), MULTI_COLUMNS)


QUERIES = {
    "scan_sales": scan_sales,
    "table_counts": table_counts,
    "unhinted_join_agg": unhinted_join_agg,
    "null_key_left_join": null_key_left_join,
    "partition_balance": partition_balance_scan,
    "partition_balance_salted": partition_balance_salted,
    "file_census": file_census_q,
    "generated_skew_profile": generated_skew_profile,
    "sales_summary": sales_summary,
    "broadcast_join_agg": broadcast_join_agg,
    "shuffle_join_agg": shuffle_join_agg,
    "write_read_back": write_read_back,
    "category_ranked": category_ranked,
    "top_products": top_products,
    "region_counts": region_counts,
    "left_outer_summary": left_outer_summary,
    "cross_summary": cross_summary,
    "skew_profile": skew_profile,
    "skewed_agg": skewed_agg,
    "salted_agg": salted_agg,
    "salted_agg_hot": salted_agg_hot,
    "salted_join": salted_join_q,
    "salted_inner_join": salted_inner_join_q,
    "sales_summary_by_date": sales_summary_by_date,
    "category_product_totals": category_product_totals,
    "category_product_totals_salted": category_product_totals_salted,
    "salted_left_join": salted_left_join_q,
    "join_fanout": join_fanout_q,
    "sorted_within_partitions": sorted_within_partitions,
    "compacted_write": compacted_write,
    "multi_analysis": multi_analysis_q,
    "multi_analysis_single_pass": multi_analysis_single_pass,
}


# --- Oracle SQL (DuckDB) ------------------------------------------------------

_SUMMARY_SQL = f"""
SELECT l_partkey AS product_id, p_type AS category, l_returnflag AS flag,
       {MONEY_PRICE} AS total_amount, COUNT(l_orderkey) AS n_sales,
       AVG(CAST(l_quantity AS INT)) AS avg_quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, p_type, l_returnflag"""

_CATEGORY_SQL = f"""
SELECT p_type AS category, {MONEY_PRICE} AS total_amount, COUNT(l_orderkey) AS n_sales
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_type"""

_REGION_SQL = f"""
SELECT COALESCE(r, '{UNKNOWN_REGION}') AS region, COUNT(c_custkey) AS n_customers
FROM (SELECT {null_region_sql('c_custkey', 'c_mktsegment')} AS r, c_custkey FROM customer) x
GROUP BY 1"""

_SKEWED_AGG_SQL = f"""
SELECT {SKEW} AS skew_key, l_returnflag AS flag, {MONEY_PRICE} AS total_amount, COUNT(*) AS n_sales
FROM lineitem GROUP BY 1, 2"""

_ORDER_LABELS_SQL = f"""
SELECT {skew_key_sql('o_orderkey')} AS skew_key, COUNT(*) AS n_orders,
       {money_sum_sql('o_totalprice')} AS order_total
FROM orders GROUP BY 1"""


def _salted_join_sql(how: str, label_filter: str) -> str:
    return f"""
SELECT f.skew_key, f.flag, COUNT(*) AS n_lines, {money_sum_sql('f.amount')} AS total_amount,
       CAST(SUM(d.n_orders) AS DECIMAL(38,0)) AS order_lines, MAX(d.order_total) AS order_total
FROM (SELECT {SKEW} AS skew_key, l_returnflag AS flag, l_extendedprice AS amount FROM lineitem) f
{how} JOIN (SELECT * FROM ({_ORDER_LABELS_SQL}) o {label_filter}) d ON f.skew_key = d.skew_key
GROUP BY f.skew_key, f.flag"""


_CATEGORY_PRODUCT_SQL = f"""
SELECT split_part(k, '_', 1) AS category, k AS skew_key, {money_sum_sql('amount')} AS total_amount, COUNT(*) AS n_sales
FROM (SELECT {SKEW} AS k, l_extendedprice AS amount FROM lineitem) x GROUP BY 1, 2"""


SQL = {
    "sales_summary_by_date": _SUMMARY_SQL.replace("l_returnflag AS flag", "CAST(l_shipdate AS DATE) AS sale_date").replace(
        "GROUP BY l_partkey, p_type, l_returnflag", "GROUP BY l_partkey, p_type, CAST(l_shipdate AS DATE)"),
    "category_product_totals": _CATEGORY_PRODUCT_SQL,
    "category_product_totals_salted": _CATEGORY_PRODUCT_SQL,
    "partition_balance": "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem",
    "partition_balance_salted": f"SELECT {SKEW} AS skew_key, COUNT(*) AS n_rows FROM lineitem GROUP BY 1",
    "table_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in COUNTED_TABLES),
    "unhinted_join_agg": _CATEGORY_SQL,
    "null_key_left_join": f"""
SELECT COALESCE(c.region, '{UNKNOWN_REGION}') AS region, COUNT(*) AS n_customers,
       COUNT(s.segment_size) AS n_matched
FROM (SELECT {null_region_sql('c_custkey', 'c_mktsegment')} AS region FROM customer) c
LEFT JOIN (SELECT c_mktsegment AS region, COUNT(*) AS segment_size FROM customer GROUP BY 1) s
  ON c.region = s.region
GROUP BY 1""",
    "scan_sales": """
SELECT l_orderkey AS sale_id, l_partkey AS product_id, l_extendedprice AS amount,
       CAST(l_quantity AS INT) AS quantity, CAST(l_shipdate AS DATE) AS sale_date, l_returnflag AS flag
FROM lineitem""",
    "sales_summary": _SUMMARY_SQL,
    "broadcast_join_agg": _CATEGORY_SQL,
    "shuffle_join_agg": _CATEGORY_SQL,
    "write_read_back": _SUMMARY_SQL,
    "category_ranked": _CATEGORY_SQL + "\nORDER BY total_amount DESC, category",
    "top_products": f"""
SELECT l_partkey AS product_id, p_name AS product_name, {MONEY_PRICE} AS total_amount
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY l_partkey, p_name ORDER BY total_amount DESC, product_id LIMIT {TOP_K}""",
    "region_counts": _REGION_SQL,
    "left_outer_summary": """
SELECT f.flag, f.n_lines, s.segment, s.n_customers
FROM (SELECT l_returnflag AS flag, COUNT(*) AS n_lines FROM lineitem GROUP BY 1) f
LEFT JOIN (SELECT c_mktsegment AS segment, COUNT(*) AS n_customers FROM customer GROUP BY 1) s
  ON f.flag = s.segment""",
    "cross_summary": f"SELECT * FROM ({_CATEGORY_SQL}) c CROSS JOIN ({_REGION_SQL}) r",
    "skew_profile": f"""
WITH c AS (SELECT {SKEW} AS skew_key, COUNT(*) AS n FROM lineitem GROUP BY 1),
     t AS (SELECT SUM(n) AS total, QUANTILE_DISC(n, 0.5) AS med FROM c)
SELECT skew_key, n, n * 1.0e0 / total AS share, n * 1.0e0 / med AS ratio_to_median
FROM c CROSS JOIN t ORDER BY n DESC, skew_key""",
    "skewed_agg": _SKEWED_AGG_SQL,
    "salted_agg": _SKEWED_AGG_SQL,
    "salted_agg_hot": _SKEWED_AGG_SQL,
    "salted_join": _salted_join_sql("INNER", ""),
    "salted_inner_join": _salted_join_sql("INNER", ""),
    "salted_left_join": _salted_join_sql("LEFT", f"WHERE skew_key <> '{SKEW_LABELS[-1]}'"),
    "join_fanout": f"""
WITH l AS (SELECT {SKEW} AS skew_key, COUNT(*) AS left_rows FROM lineitem GROUP BY 1),
     r AS (SELECT {skew_key_sql('o_orderkey')} AS skew_key, COUNT(*) AS right_rows FROM orders GROUP BY 1),
     p AS (SELECT l.skew_key, left_rows, right_rows, CAST(CAST(left_rows AS HUGEINT) * right_rows AS DECIMAL(38,0)) AS pairs
           FROM l JOIN r ON l.skew_key = r.skew_key)
SELECT p.*, (SELECT CAST(SUM(CAST(pairs AS HUGEINT)) AS DECIMAL(38,0)) FROM p) AS total_pairs FROM p""",
    "sorted_within_partitions": """
SELECT l_orderkey AS sale_id, l_partkey AS product_id, l_returnflag AS flag, l_extendedprice AS amount
FROM lineitem""",
    "compacted_write": f"""
SELECT p_type AS category, CAST(l_shipdate AS DATE) AS sale_date,
       {MONEY_PRICE} AS total_amount, COUNT(l_orderkey) AS n_sales
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2""",
    "multi_analysis": f"""
SELECT 'by_category' AS analysis, p_type AS category, CAST(NULL AS DATE) AS sale_date,
       CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS product_name,
       {MONEY_PRICE} AS total_amount, COUNT(l_orderkey) AS n_sales
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
UNION ALL
SELECT 'by_date', NULL, CAST(l_shipdate AS DATE), NULL, NULL, NULL, COUNT(l_orderkey)
FROM lineitem GROUP BY CAST(l_shipdate AS DATE)
UNION ALL
SELECT 'by_product', NULL, NULL, l_partkey, p_name, {MONEY_PRICE}, NULL
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_partkey, p_name""",
}
SQL["multi_analysis_single_pass"] = SQL["multi_analysis"]
