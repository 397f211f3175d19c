from pyspark.sql import functions as F

from conftest import plan_text
from skewkit.operators.ordering import ranked, sort_within_partitions, top_k
from skewkit.operators.profile import balance_summary, key_distribution, partition_balance


def test_top_k_ties_and_plan(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "id long, v double")
    out = top_k(df, 4, ["v"], ["id"])
    assert [r["id"] for r in out.collect()] == [2, 5, 8, 11]
    assert "TakeOrderedAndProject" in plan_text(out)


def test_ranked_nulls_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 7.0)], "id long, v double")
    assert [r["id"] for r in ranked(df, ["v"], ["id"]).collect()] == [3, 2, 1]


def test_sort_within_partitions_has_no_exchange(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 17)
    out = sort_within_partitions(df, ["v"])
    out.collect()
    assert "Exchange" not in plan_text(out)
    part = sort_within_partitions(df, ["v"], ["v"], 4)
    for p in part.rdd.glom().collect():
        vs = [r["v"] for r in p]
        assert vs == sorted(vs)


def test_key_distribution(spark):
    df = spark.createDataFrame([("a",)] * 8 + [("b",)] * 1 + [("c",)] * 1 + [(None,)] * 2, "k string")
    out = {r["key"]: r for r in key_distribution(df, "k").collect()}
    assert out["a"]["n"] == 8
    assert abs(sum(r["share"] for r in out.values()) - 1) < 1e-12
    assert out["a"]["ratio_to_median"] == 8.0
    assert None in out


def test_partition_balance(spark):
    df = spark.range(0, 1000, 1, 4)
    bal = partition_balance(df)
    assert sum(r["n_rows"] for r in bal.collect()) == 1000
    s = balance_summary(bal).first()
    assert s["partitions"] == 4 and s["largest_share"] == 0.25


def test_range_clustering_splits_a_large_key(spark):
    df = spark.range(4000).withColumn("k", F.when(F.col("id") < 3000, "big").otherwise("small"))
    out = sort_within_partitions(df, ["id"], ["k"], 4)
    parts = [p for p in out.rdd.glom().collect() if p]
    assert sum(1 for p in parts if any(r["k"] == "big" for r in p)) > 1
    for p in parts:
        keys = [(r["k"], r["id"]) for r in p]
        assert [x[1] for x in keys] == sorted(x[1] for x in keys)
