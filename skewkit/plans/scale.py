"""Registered queries of the operators that keep skewed and large inputs bounded, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.functions.expressions import cents, cents_to_money, hot_product_sql, money_sum, money_sum_sql, skew_key_sql
from skewkit.operators.incremental import apply_batch, current_totals
from skewkit.operators.joins import join_fanout, join_strategy, salted_join
from skewkit.operators.prefix import group_percentiles, running_totals, salted_distinct
from skewkit.operators.reduction import reduced_join
from skewkit.operators.sketches import fanout_bound
from skewkit.operators.skew import bounded_hot_keys, heavy_hitters, skew_split_join
from skewkit.operators.profile import balance_summary, partition_balance
from skewkit.plans import retail, star
from skewkit.plans.jobs import run_retail_job
from skewkit.schema import CUSTOMERS, PRODUCTS, SALES
from skewkit.session import scratch_path
from skewkit.sinks.layout import clustered_write, compact_files, replace_partitions, write_bucketed
from skewkit.sinks.writers import write_parquet
from skewkit.sources.tables import read_table

#: Share of rows above which a key of each column counts as heavy.
HEAVY = {"user_id": 0.002, "skew_key": 0.01, "product_id": 0.0004}
REDUCED_CATEGORY = "SMALL"


def skew_split_join_q(spark: SparkSession, base: str) -> DataFrame:
    """Per (product, category) of sales of which one product has 80 %: a join of two shuffled sides that AQE may split."""
    joined = skew_split_join(star.hot_product_sales(spark, base), star.products(spark, base), "product_id")
    return joined.groupBy("product_id", "category").agg(money_sum("amount").alias("total_amount"), F.count("sale_id").alias("n_sales"))


def heavy_hitters_q(spark: SparkSession, base: str) -> DataFrame:
    """Keys above a share of the events' users, of the skewed key and of the products of the hot-product sales."""
    facts = {"user_id": read_table(spark, base, "events", ["user_id"]), "skew_key": star.skewed_sales(spark, base),
             "product_id": star.hot_product_sales(spark, base)}
    parts = [heavy_hitters(df, key, HEAVY[key]).select(F.lit(key).alias("key_column"), F.col(key).cast("string").alias("key"), "n_rows", "share")
             for key, df in facts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def salted_join_bounded(spark: SparkSession, base: str) -> DataFrame:
    """The salted inner join with its hot keys from a bounded summary."""
    fact = star.skewed_sales(spark, base).select("sale_id", "skew_key", "flag", "amount", "sale_ts")
    joined = salted_join(fact, star.order_labels(spark, base), "skew_key", "inner", hot=bounded_hot_keys(fact, "skew_key"), broadcast_max_rows=0)
    return retail._salted_join_summary(joined)


def reduced_join_agg(spark: SparkSession, base: str) -> DataFrame:
    """Per product of one category, by a shuffled join whose other sales leave before the exchange."""
    few = star.products(spark, base).where(F.col("category") == REDUCED_CATEGORY)
    joined = reduced_join(star.sales(spark, base), few, "product_id")
    return joined.groupBy("product_id", "product_name").agg(money_sum("amount").alias("total_amount"), F.count("sale_id").alias("n_sales"))


def fanout_bounds(spark: SparkSession, base: str) -> DataFrame:
    """Three joins' exact pairs, and whether the sketches' bound is not below them and within its stated error."""
    order_keys = read_table(spark, base, "orders", ["o_orderkey", "o_custkey"])
    sides = {
        "skew_key": (star.skewed_sales(spark, base), order_keys.select(F.expr(skew_key_sql("o_orderkey")).alias("skew_key"))),
        "product_id": (star.hot_product_sales(spark, base), star.sales(spark, base)),
        "customer_id": (order_keys.withColumnRenamed("o_custkey", "customer_id"), star.customers(spark, base)),
    }
    out = None
    for key, (left, right) in sides.items():
        exact = join_fanout(left, right, key).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("decimal(38,0)").alias("total_pairs"))
        part = fanout_bound(left, right, key).crossJoin(F.broadcast(exact)).select(  # one row each
            F.lit(key).alias("join_key"), "total_pairs", "left_rows", "right_rows",
            (F.col("pairs_at_most") >= F.col("total_pairs")).alias("holds"),
            (F.col("pairs_at_most") - F.col("total_pairs") <= F.col("error_at_most")).alias("within_error"))
        out = part if out is None else out.unionByName(part)
    return out


def skewed_order_statistics(spark: SparkSession, base: str) -> DataFrame:
    """Per skewed key: exact distinct products and days, median and 90th percentile of the amount."""
    s = star.skewed_sales(spark, base).withColumn("sale_date", F.to_date("sale_ts"))
    keys = ["skew_key"]
    distinct = salted_distinct(s, keys, {"n_products": "product_id", "n_days": "sale_date"})
    places = group_percentiles(s, keys, "amount", {"median_amount": 0.5, "p90_amount": 0.9})
    between = group_percentiles(s, keys, "quantity", {"mid_quantity": 0.5, "p95_quantity": 0.95}, interpolate=True)
    return distinct.join(places, keys).join(between, keys)


_ORDER = ["sale_date", "sale_id", "product_id", "amount"]


def _dated(spark: SparkSession, base: str) -> DataFrame:
    return star.sales(spark, base).select(F.to_date("sale_ts").alias("sale_date"), "sale_id", "product_id", "amount", "flag")


def running_sales(spark: SparkSession, base: str) -> DataFrame:
    """Every sale with its place by date and the money taken up to it."""
    out = running_totals(_dated(spark, base).drop("flag"), _ORDER, {"_cents": cents("amount")})
    return out.withColumn("running_amount", cents_to_money(F.col("_cents"))).drop("_cents")


def running_sales_by_flag(spark: SparkSession, base: str) -> DataFrame:
    """The same within each flag: three groups that no task holds whole."""
    out = running_totals(_dated(spark, base), _ORDER, {"_cents": cents("amount")}, by=["flag"], totals={"_cents": "_all"})
    return out.select(*_ORDER, "flag", "rank", cents_to_money(F.col("_cents")).alias("running_amount"),
                      cents_to_money(F.col("_all")).alias("flag_amount"))


BUCKETS = 16


def bucketed_order_totals(spark: SparkSession, base: str) -> DataFrame:
    """Orders joined with their lines and summed per order, over two tables bucketed alike: no exchange."""
    lines = write_bucketed(read_table(spark, base, "lineitem", ["l_orderkey", "l_extendedprice"]), "l_orderkey", BUCKETS, "lines")
    orders = write_bucketed(read_table(spark, base, "orders", ["o_orderkey", "o_orderstatus"]), "o_orderkey", BUCKETS, "orders")
    joined = lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"])
    return joined.groupBy("l_orderkey", "o_orderstatus").agg(money_sum("l_extendedprice").alias("total_amount"),
                                                             F.count(F.lit(1)).alias("n_lines"))


def _event_days(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value"]).withColumn("day", F.to_date("ts"))


def replaced_days(spark: SparkSession, base: str) -> DataFrame:
    """Events by day, of which one day was wrong and two days are written again: only these partitions are replaced."""
    days = _event_days(spark, base)
    first = F.lit("2024-01-02").cast("date")
    path = scratch_path(spark, "event-days")
    replace_partitions(days.withColumn("value", F.when(F.col("day") == first, F.lit(-1.0)).otherwise(F.col("value"))), path, ["day"])
    for _ in range(2):  # idempotent
        replace_partitions(days.where(F.col("day").isin("2024-01-02", "2024-01-05")), path, ["day"])
    return spark.read.parquet(path).groupBy("day").agg(F.count("event_id").alias("n_events"), money_sum("value").alias("total_value"))


def pruned_days(spark: SparkSession, base: str) -> DataFrame:
    """Events of the days with most users, from a table partitioned by day: the join prunes the partitions it reads."""
    path = replace_partitions(_event_days(spark, base), scratch_path(spark, "event-days"), ["day"])
    events = spark.read.parquet(path)
    calendar = spark.read.parquet(write_parquet(
        _event_days(spark, base).groupBy("day").agg(F.countDistinct("user_id").alias("users"), F.dayofweek("day").alias("weekday")),
        scratch_path(spark, "calendar")))
    mondays = calendar.where("weekday = 2")
    return events.join(F.broadcast(mondays), "day").groupBy("day", "event_type").agg(  # a row per day at most
        F.count("event_id").alias("n_events"), F.max("users").alias("users"))


def clustered_sales(spark: SparkSession, base: str) -> DataFrame:
    """Sales written along a Z-order curve over (product, date), and read back by a filter on each."""
    path = clustered_write(_dated(spark, base), scratch_path(spark, "z-sales"), ["product_id", "sale_date"], files=8)
    sales = spark.read.parquet(path)
    few = sales.where("product_id BETWEEN 10 AND 19").withColumn("filter", F.lit("product"))
    month = sales.where("sale_date BETWEEN DATE'1997-03-01' AND DATE'1997-03-31'").withColumn("filter", F.lit("date"))
    return few.unionByName(month)


def compacted_files(spark: SparkSession, base: str) -> DataFrame:
    """Orders written as one large and many small files, of which only the small ones are rewritten."""
    root = scratch_path(spark, "fragmented")
    orders = read_table(spark, base, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])
    bulk, rest = orders.where("o_orderkey % 4 > 0"), orders.where("o_orderkey % 4 = 0 OR o_orderkey IS NULL")
    bulk.repartition(1).write.parquet(root)
    size = spark.read.parquet(root).select(F.max("_metadata.file_size")).first()[0]
    rest.repartition(24).write.mode("append").parquet(root)
    return spark.read.parquet(*compact_files(spark, root, f"{root}-compacted", size, max(1, size // 4)))


def incremental_totals(spark: SparkSession, base: str) -> DataFrame:
    """Totals per (flag, product) after a first load, late rows (loaded twice) and a correction of wrong amounts."""
    path, keys = scratch_path(spark, "totals"), ["flag", "product_id"]
    s = star.sales(spark, base).select(*keys, "sale_id", "amount")
    share = F.col("sale_id") % 10
    wrong = F.when(share == 3, F.col("amount") + 100).otherwise(F.col("amount"))
    apply_batch(s.where((share < 8) | F.col("sale_id").isNull()).withColumn("amount", wrong), path, "load", keys, "amount")
    for _ in range(2):  # counted once
        apply_batch(s.where(share >= 8), path, "late", keys, "amount")
    old = s.where(share == 3).withColumn("sign", F.lit(-1)).withColumn("amount", F.col("amount") + 100)
    new = s.where(share == 3).withColumn("sign", F.lit(1))
    apply_batch(old.unionByName(new), path, "correction", keys, "amount", sign="sign")
    return current_totals(spark, path, keys)


PARTS = 16


def _by_id(spark: SparkSession, base: str, salted: bool) -> DataFrame:
    """Rows per physical partition of the skewed fact, dealt by its key, or by key and salt."""
    s = star.skewed_sales(spark, base).select("skew_key", "sale_id")
    key = F.length("skew_key")
    return partition_balance(s.repartitionById(PARTS, ((key + F.col("sale_id") if salted else key) % PARTS).cast("int")))


def partition_rows(spark: SparkSession, base: str) -> DataFrame:
    """Rows of each physical partition, dealt by the skewed key and by key and salt."""
    return _by_id(spark, base, False).withColumn("dealt", F.lit("key")).unionByName(
        _by_id(spark, base, True).withColumn("dealt", F.lit("key and salt")))


def partition_skew(spark: SparkSession, base: str) -> DataFrame:
    """Partitions with rows, largest, median, their ratio and the largest share, before and after salting."""
    return balance_summary(_by_id(spark, base, False)).withColumn("dealt", F.lit("key")).unionByName(
        balance_summary(_by_id(spark, base, True)).withColumn("dealt", F.lit("key and salt")))


#: The dimensions whose measured size picks a join, and their columns with text.
DIMENSIONS = {"part": ["p_partkey", "p_name", "p_type"], "customer": ["c_custkey", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey"]}
STRATEGY_BYTES = (64 * 1024, 512 * 1024)


def join_strategies(spark: SparkSession, base: str) -> DataFrame:
    """The join that the three-tier size rule picks for each dimension, with bounds of 64 and 512 KB."""
    out = []
    for table, columns in DIMENSIONS.items():
        tier, size = join_strategy(read_table(spark, base, table, columns), *STRATEGY_BYTES)
        out.append((table, size.rows, size.bytes, tier))
    return spark.createDataFrame(out, "dimension string, n_rows bigint, n_bytes bigint, strategy string")


def retail_job(spark: SparkSession, base: str) -> DataFrame:
    """The whole retail job over tables of its own shape written from the given ones: summary and regions as one table."""
    paths = {n: scratch_path(spark, f"job-{n}") for n in ("sales", "products", "customers", "out")}
    s = star.sales(spark, base).withColumn("sale_date", F.to_date("sale_ts"))
    tables = {"sales": (s, SALES), "products": (star.products(spark, base), PRODUCTS),
              "customers": (star.customers(spark, base).withColumn("monthly_income", F.lit(0)), CUSTOMERS)}
    for name, (df, schema) in tables.items():
        write_parquet(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), paths[name])
    run_retail_job(spark, paths["sales"], paths["products"], paths["customers"], paths["out"])
    summary = spark.read.parquet(f"{paths['out']}/summary").withColumn("part", F.lit("summary")).withColumn(
        "product_id", F.col("product_id").cast("bigint"))
    regions = spark.read.parquet(f"{paths['out']}/regions").withColumn("part", F.lit("regions"))
    return summary.unionByName(regions, allowMissingColumns=True)


QUERIES = {
    "skew_split_join": skew_split_join_q,
    "heavy_hitters": heavy_hitters_q,
    "salted_join_bounded": salted_join_bounded,
    "reduced_join_agg": reduced_join_agg,
    "fanout_bounds": fanout_bounds,
    "skewed_order_statistics": skewed_order_statistics,
    "running_sales": running_sales,
    "running_sales_by_flag": running_sales_by_flag,
    "bucketed_order_totals": bucketed_order_totals,
    "replaced_days": replaced_days,
    "pruned_days": pruned_days,
    "clustered_sales": clustered_sales,
    "compacted_files": compacted_files,
    "incremental_totals": incremental_totals,
    "partition_rows": partition_rows,
    "partition_skew": partition_skew,
    "join_strategies": join_strategies,
    "retail_job": retail_job,
}

_HOT = hot_product_sql("l_orderkey", "l_partkey")
_SKEW = skew_key_sql("l_orderkey")


def _heavy_sql(name: str, key: str, table: str) -> str:
    return f"""
SELECT '{name}' AS key_column, CAST(k AS VARCHAR) AS key, COUNT(*) AS n_rows,
       COUNT(*) * 1.0e0 / (SELECT COUNT(*) FROM {table}) AS share
FROM (SELECT {key} AS k FROM {table}) x GROUP BY k
HAVING COUNT(*) * 1.0e0 / (SELECT COUNT(*) FROM {table}) > {HEAVY[name]}e0"""


def _pairs_sql(name: str, left: str, right: str) -> str:
    return f"""
SELECT '{name}' AS join_key,
       (SELECT CAST(COALESCE(SUM(CAST(a.n AS HUGEINT) * b.n), 0) AS DECIMAL(38,0))
        FROM (SELECT k, COUNT(*) AS n FROM ({left}) l GROUP BY k) a JOIN (SELECT k, COUNT(*) AS n FROM ({right}) r GROUP BY k) b
        ON a.k = b.k) AS total_pairs,
       (SELECT COUNT(k) FROM ({left}) l) AS left_rows, (SELECT COUNT(k) FROM ({right}) r) AS right_rows,
       TRUE AS holds, TRUE AS within_error"""


def _parts_sql(salted: bool) -> str:
    place = f"(LENGTH({_SKEW}) + {'l_orderkey' if salted else 0}) % {PARTS}"
    return f"SELECT '{'key and salt' if salted else 'key'}' AS dealt, CAST({place} AS INT) AS partition_id, COUNT(*) AS n_rows FROM lineitem GROUP BY 2"


def _strategy_sql(table: str, fixed: int, texts: tuple[str, ...]) -> str:
    size = " + ".join([str(fixed), *[f"COALESCE(strlen({c}), 0) + 8" for c in texts]])
    return f"""
SELECT *, CASE WHEN n_bytes <= {STRATEGY_BYTES[0]} THEN 'broadcast' WHEN n_bytes <= {STRATEGY_BYTES[1]} THEN 'consider' ELSE 'planner' END AS strategy
FROM (SELECT '{table}' AS dimension, COUNT(*) AS n_rows, CAST(COALESCE(SUM({size}), 0) AS BIGINT) AS n_bytes FROM {table}) x"""


_DATED_SQL = """SELECT CAST(l_shipdate AS DATE) AS sale_date, l_orderkey AS sale_id, l_partkey AS product_id,
       l_extendedprice AS amount"""
_CENTS_SQL = "CAST(ROUND(l_extendedprice * 100) AS HUGEINT)"
_BY_DATE_SQL = "ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING"

SQL = {
    "skew_split_join": f"""
SELECT k AS product_id, p_type AS category, {money_sum_sql('l_extendedprice')} AS total_amount, COUNT(l_orderkey) AS n_sales
FROM (SELECT {_HOT} AS k, l_orderkey, l_extendedprice FROM lineitem) s JOIN part ON k = p_partkey GROUP BY 1, 2""",
    "heavy_hitters": "\nUNION ALL\n".join((
        _heavy_sql("user_id", "user_id", "events"), _heavy_sql("skew_key", _SKEW, "lineitem"),
        _heavy_sql("product_id", _HOT, "lineitem"))),
    "salted_join_bounded": retail.SQL["salted_inner_join"],
    "reduced_join_agg": f"""
SELECT l_partkey AS product_id, p_name AS product_name, {money_sum_sql('l_extendedprice')} AS total_amount, COUNT(l_orderkey) AS n_sales
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type = '{REDUCED_CATEGORY}' GROUP BY 1, 2""",
    "fanout_bounds": "\nUNION ALL\n".join((
        _pairs_sql("skew_key", f"SELECT {_SKEW} AS k FROM lineitem", f"SELECT {skew_key_sql('o_orderkey')} AS k FROM orders"),
        _pairs_sql("product_id", f"SELECT {_HOT} AS k FROM lineitem", "SELECT l_partkey AS k FROM lineitem"),
        _pairs_sql("customer_id", "SELECT o_custkey AS k FROM orders", "SELECT c_custkey AS k FROM customer"))),
    "skewed_order_statistics": f"""
SELECT {_SKEW} AS skew_key, COUNT(DISTINCT l_partkey) AS n_products, COUNT(DISTINCT CAST(l_shipdate AS DATE)) AS n_days,
       QUANTILE_DISC(l_extendedprice, 0.5) AS median_amount, QUANTILE_DISC(l_extendedprice, 0.9) AS p90_amount,
       QUANTILE_CONT(CAST(CAST(l_quantity AS INT) AS DOUBLE), 0.5) AS mid_quantity,
       QUANTILE_CONT(CAST(CAST(l_quantity AS INT) AS DOUBLE), 0.95) AS p95_quantity
FROM lineitem GROUP BY 1""",
    "running_sales": f"""
{_DATED_SQL}, ROW_NUMBER() OVER w AS rank, CAST(SUM({_CENTS_SQL}) OVER w AS DOUBLE) / 100.0e0 AS running_amount
FROM lineitem WINDOW w AS ({_BY_DATE_SQL})""",
    "running_sales_by_flag": f"""
{_DATED_SQL}, l_returnflag AS flag, ROW_NUMBER() OVER w AS rank, CAST(SUM({_CENTS_SQL}) OVER w AS DOUBLE) / 100.0e0 AS running_amount,
       CAST(SUM({_CENTS_SQL}) OVER (PARTITION BY l_returnflag) AS DOUBLE) / 100.0e0 AS flag_amount
FROM lineitem WINDOW w AS (PARTITION BY l_returnflag {_BY_DATE_SQL})""",
    "bucketed_order_totals": f"""
SELECT l_orderkey, o_orderstatus, {money_sum_sql('l_extendedprice')} AS total_amount, COUNT(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "replaced_days": f"""
SELECT CAST(ts AS DATE) AS day, COUNT(event_id) AS n_events, {money_sum_sql('value')} AS total_value FROM events GROUP BY 1""",
    "pruned_days": """
WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id, event_type, user_id FROM events),
     c AS (SELECT day, COUNT(DISTINCT user_id) AS users FROM e GROUP BY day)
SELECT e.day, event_type, COUNT(event_id) AS n_events, MAX(users) AS users
FROM e JOIN c ON e.day = c.day WHERE dayofweek(e.day) = 1 GROUP BY e.day, event_type""",
    "clustered_sales": f"""
{_DATED_SQL}, l_returnflag AS flag, 'product' AS filter FROM lineitem WHERE l_partkey BETWEEN 10 AND 19
UNION ALL
{_DATED_SQL}, l_returnflag, 'date' FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'""",
    "compacted_files": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "incremental_totals": f"""
SELECT l_returnflag AS flag, l_partkey AS product_id, {money_sum_sql('l_extendedprice')} AS total_amount, COUNT(*) AS n_rows
FROM lineitem GROUP BY 1, 2""",
    "partition_rows": f"{_parts_sql(False)}\nUNION ALL\n{_parts_sql(True)}",
    "partition_skew": f"""
SELECT dealt, COUNT(*) AS partitions, MAX(n_rows) AS max_rows, QUANTILE_DISC(n_rows, 0.5) AS median_rows,
       MAX(n_rows) * 1.0e0 / QUANTILE_DISC(n_rows, 0.5) AS max_to_median, MAX(n_rows) * 1.0e0 / SUM(n_rows) AS largest_share
FROM ({_parts_sql(False)}\nUNION ALL\n{_parts_sql(True)}) p GROUP BY dealt""",
    "join_strategies": "\nUNION ALL\n".join((
        _strategy_sql("part", 8, ("p_name", "p_type")), _strategy_sql("customer", 8, ("c_mktsegment",)), _strategy_sql("orders", 16, ()))),
    "retail_job": f"""
SELECT 'summary' AS part, product_id, category, sale_date, total_amount, n_sales, avg_quantity,
       CAST(NULL AS VARCHAR) AS region, CAST(NULL AS BIGINT) AS n_customers
FROM ({retail.SQL["sales_summary_by_date"]}) s
UNION ALL
SELECT 'regions', NULL, NULL, NULL, NULL, NULL, NULL, region, n_customers FROM ({retail.SQL["region_counts"]}) r""",
}
