import os
import tempfile

from pyspark.sql import functions as F

from skewkit.plans.jobs import run_retail_job
from skewkit.sinks.writers import write_parquet
from skewkit.sources.generators import generate_customers, generate_products, generate_sales


def test_retail_job_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="skewkit-job-")
    paths = {n: os.path.join(d, n) for n in ("sales", "products", "customers", "out")}
    write_parquet(generate_sales(spark, 50_000, 4), paths["sales"])
    write_parquet(generate_products(spark, 1000), paths["products"])
    write_parquet(generate_customers(spark, 10_000, 4), paths["customers"])
    res = run_retail_job(spark, paths["sales"], paths["products"], paths["customers"], paths["out"])
    summary = res.summary.collect()
    # 4 sold products x 2 dates; only sold products appear
    assert len(summary) == 8
    assert sum(r["n_sales"] for r in summary) == 50_000
    regions = {r["region"]: r["n_customers"] for r in res.regions.collect()}
    assert set(regions) == {"UNKNOWN", "SP", "RJ", "MG"} and sum(regions.values()) == 10_000
    assert spark.read.parquet(f"{paths['out']}/summary").agg(F.sum("n_sales")).first()[0] == 50_000
    assert spark.read.parquet(f"{paths['out']}/regions").count() == 4


def test_retail_job_bounds_the_groups_of_a_task(spark, monkeypatch):
    from skewkit.operators import aggregates
    from skewkit.plans.jobs import retail_job

    monkeypatch.setattr(aggregates, "GROUPS_PER_TASK", 50, raising=False)
    sales = spark.range(2000).select(
        F.col("id").alias("sale_id"), (F.col("id") % 20).cast("int").alias("product_id"), (F.col("id") % 100 / 4).alias("amount"),
        (F.col("id") % 7).cast("int").alias("quantity"), F.expr("date_add(date'2024-01-01', cast(id div 20 as int))").alias("sale_date"))
    products = spark.createDataFrame([(i, f"p{i}", f"c{i % 3}") for i in range(20)], "product_id int, product_name string, category string")
    customers = spark.createDataFrame([(1, "SP", 1.0), (2, None, 1.0)], "customer_id int, region string, monthly_income double")
    summary = retail_job(sales, products, customers).summary
    held = [r["count"] for r in summary.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 2000 and max(held) <= 4 * 50
