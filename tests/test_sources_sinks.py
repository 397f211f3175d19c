import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from skewkit.schema import TABLES
from skewkit.sinks.writers import plan_files, sized_write, write_parquet
from skewkit.sources.files import file_census, list_files
from skewkit.sources.generators import (
    generate_customers,
    generate_products,
    generate_sales,
    skew_rekey,
)
from skewkit.sources.tables import read_table


def test_declared_schema_read_and_pruning(spark):
    df = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_partkey"])
    assert df.columns == ["l_orderkey", "l_partkey"]
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    full = read_table(spark, SF_SMALL, "lineitem")
    assert full.schema == TABLES["lineitem"]


def test_unknown_table():
    with pytest.raises(KeyError):
        read_table(None, SF_SMALL, "nope")


def test_generators_are_repeatable_and_skewed(spark):
    a = generate_sales(spark, 20_000, 4, seed=1)
    b = generate_sales(spark, 20_000, 8, seed=1)
    assert rows(a) == rows(b)
    shares = {r["product_id"]: r["count"] / 20_000 for r in a.groupBy("product_id").count().collect()}
    assert abs(shares["PROMO_ESPECIAL"] - 0.80) < 0.01
    assert abs(shares["PRODUTO_A"] - 0.18) < 0.01
    dates = {r["sale_date"].isoformat(): r["count"] / 20_000 for r in a.groupBy("sale_date").count().collect()}
    assert abs(dates["2024-01-01"] - 0.70) < 0.01
    q = a.agg(F.min("quantity"), F.max("quantity")).first()
    assert q[0] >= 0 and q[1] <= 99


def test_product_and_customer_generators(spark):
    p = generate_products(spark, 1000)
    assert p.count() == 1000 and p.select("product_id").distinct().count() == 1000
    c = generate_customers(spark, 20_000, 4)
    nulls = c.where(F.col("region").isNull()).count() / 20_000
    assert abs(nulls - 0.30) < 0.01


def test_skew_rekey_keeps_rows(spark):
    li = read_table(spark, SF_SMALL, "lineitem", ["l_orderkey", "l_linenumber"])
    out = skew_rekey(li, ["l_orderkey", "l_linenumber"])
    assert out.count() == li.count()


def test_sized_write_and_census(spark):
    d = tempfile.mkdtemp(prefix="skewkit-test-")
    df = spark.range(0, 200_000, 1, 16).withColumn("s", F.format_string("row-%08d", "id"))
    plan = plan_files(df, target_file_bytes=1_000_000)
    assert plan.rows == 200_000 and plan.files == -(-plan.est_bytes // 1_000_000)
    sized_write(df, os.path.join(d, "sized"), target_file_bytes=1_000_000)
    write_parquet(df.repartition(40), os.path.join(d, "small"))
    census = {os.path.basename(r["directory"]): r for r in file_census(spark, d).collect()}
    assert census["small"]["files"] == 40
    assert census["sized"]["files"] <= plan.files
    assert census["sized"]["files"] >= 1
    assert spark.read.parquet(os.path.join(d, "sized")).count() == 200_000
    assert list_files(spark, d).count() == census["small"]["files"] + census["sized"]["files"]


def test_rebalanced_write_is_single_pass_and_complete(spark):
    d = tempfile.mkdtemp(prefix="skewkit-test-")
    df = spark.range(0, 50_000, 1, 64).withColumn("k", F.col("id") % 5)
    assert sized_write(df, os.path.join(d, "r"), cluster_by=["k"]) is None
    back = spark.read.parquet(os.path.join(d, "r"))
    assert back.count() == 50_000
    n_files = file_census(spark, d).first()["files"]
    assert n_files < 64


def test_scale_settings_and_byte_strings():
    from skewkit.plans.settings import scale_settings
    from skewkit.session import parse_bytes

    s = scale_settings(100 * 1024**4, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 819200
    assert scale_settings(1024, 8)["spark.sql.shuffle.partitions"] == "16"
    assert parse_bytes("64MB") == 64 << 20 and parse_bytes("1g") == 1 << 30 and parse_bytes("123") == 123
    with pytest.raises(ValueError):
        parse_bytes("12 parsecs")


def test_generators_match_declared_schemas(spark):
    from skewkit.schema import CUSTOMERS, PRODUCTS, SALES

    def shape(df):
        return [(f.name, f.dataType) for f in df.schema.fields]

    assert shape(generate_sales(spark, 10)) == shape(spark.createDataFrame([], SALES))
    assert shape(generate_products(spark, 10)) == shape(spark.createDataFrame([], PRODUCTS))
    assert shape(generate_customers(spark, 10)) == shape(spark.createDataFrame([], CUSTOMERS))


def test_object_store_paths_pass_through():
    from skewkit.sources.tables import table_path

    assert table_path("s3://bucket/prefix/", "lineitem") == "s3://bucket/prefix/lineitem.parquet"
    assert table_path(SF_SMALL, "lineitem").endswith("lineitem.parquet")


def test_sized_write_exact_file_count(spark):
    d = tempfile.mkdtemp(prefix="skewkit-test-")
    df = spark.range(0, 30_000, 1, 64)
    sized_write(df, os.path.join(d, "f"), files=12)
    assert file_census(spark, d).first()["files"] == 12
    assert spark.read.parquet(os.path.join(d, "f")).count() == 30_000
