import pytest
from pyspark.sql import functions as F

from skewkit.operators.reuse import multi_analysis, reused


def test_reused_refuses_single_consumer(spark):
    with pytest.raises(ValueError):
        with reused(spark.range(3), consumers=1):
            pass


def test_reused_always_unpersists(spark):
    df = spark.range(100)
    with pytest.raises(RuntimeError):
        with reused(df, consumers=2) as c:
            assert c.is_cached
            raise RuntimeError("analysis failed")
    assert not df.is_cached


def test_multi_analysis_union(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    out = multi_analysis(
        df,
        [("count", lambda d: d.groupBy("g").agg(F.count("*").alias("n"))),
         ("sum", lambda d: d.groupBy("g").agg(F.sum("id").alias("s")))],
        {"g": "bigint", "n": "bigint", "s": "bigint"},
    )
    assert not df.is_cached
    got = {(r["analysis"], r["g"]): (r["n"], r["s"]) for r in out.collect()}
    assert got[("count", 0)] == (34, None)
    assert got[("sum", 1)] == (None, sum(range(1, 100, 3)))
