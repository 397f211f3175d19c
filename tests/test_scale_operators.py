"""Skew splits, heavy hitters, semi-join reduction, sketch bounds, running totals and order statistics."""

import random
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, plan_text, rows
from skewkit.operators.joins import join_fanout
from skewkit.operators.prefix import group_percentiles, running_totals, salted_distinct
from skewkit.operators.reduction import key_bitmaps, reduce_to_keys, reduced_join
from skewkit.operators.sketches import fanout_bound
from skewkit.operators.skew import bounded_hot_keys, frequent_keys, heavy_hitters, skew_split_join
from skewkit.plans import scale, star
from skewkit.session import materialize


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_rows(df):
    """Rows written by each shuffle of the finished plan."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return out


@pytest.fixture(scope="module")
def hot_sales(spark):
    """Sales of which one product has 80 %, in eight files, so that AQE has map outputs to split by."""
    return materialize(star.hot_product_sales(spark, SF_ORACLE).repartition(8), "hot-sales")


# --- the join that AQE splits ---

def test_aqe_splits_the_hot_partition(spark, hot_sales):
    products = star.products(spark, SF_ORACLE)
    with settings(spark, spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
                  spark__sql__adaptive__advisoryPartitionSizeInBytes="32k", spark__sql__shuffle__partitions="16"):
        joined = skew_split_join(hot_sales, products, "product_id").groupBy("product_id", "category").agg(
            F.count("sale_id").alias("n"), F.max("amount").alias("top"), F.max("sale_ts").alias("last"))
        got = rows(joined)
        assert "skew=true" in plan_text(joined)
        plain = hot_sales.join(products.hint("merge"), "product_id").groupBy("product_id", "category").agg(
            F.count("sale_id").alias("n"), F.max("amount").alias("top"), F.max("sale_ts").alias("last"))
        assert got == rows(plain)
        assert "skew=true" not in plan_text(plain)  # the grouping pins the key, so Spark may not split


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_skew_split_join_equals_a_join(spark, how):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (5, "q")], "k int, a string")
    b = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 0), (5, 50)], "k int, b int")
    assert rows(skew_split_join(a, b, "k", how)) == rows(a.join(b, "k", how))
    assert skew_split_join(a, b, "k", how).columns == a.join(b, "k", how).columns


def test_skew_split_join_refuses_and_falls_back(spark):
    a = spark.createDataFrame([(1, 2)], "k int, a int")
    with pytest.raises(ValueError):
        skew_split_join(a, a.withColumnRenamed("a", "b"), "k", "full")
    with pytest.raises(ValueError, match="not found"):
        skew_split_join(a, a.withColumnRenamed("k", "other"), "k")
    with settings(spark, spark__sql__adaptive__skewJoin__enabled="false"):
        assert rows(skew_split_join(a, a.withColumnRenamed("a", "b"), "k")) == [(1, 2, 2)]
        with pytest.raises(ValueError, match="AQE"):
            skew_split_join(a, a.withColumnRenamed("a", "b"), "k", "right")


# --- heavy hitters ---

def test_heavy_hitters_shuffle_does_not_grow_with_the_keys(spark):
    def keyed(n):
        return spark.range(0, 200_000, numPartitions=8).select(F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("id") % n).alias("k"))

    written = []
    for n in (1_000, 150_000):
        got = heavy_hitters(keyed(n), "k", 0.05)
        written.append(sum(shuffled_rows(got)))
        assert [(r["k"], r["n_rows"]) for r in got.collect()] == [(-1, 40_000)]
    assert written[1] <= written[0] + 200 and written[1] < 1_500
    assert sum(shuffled_rows(frequent_keys(keyed(150_000), "k", 0.05))) <= 8


def test_heavy_hitters_are_complete_on_zipf_keys(spark):
    rng = np.random.default_rng(4)
    for share in (0.2, 0.01, 0.002):
        keys = [int(x) if x < 5_000 else None for x in rng.zipf(1.3, 20_000)]
        n = Counter(keys)
        df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(6)
        got = {r["k"]: r["n_rows"] for r in heavy_hitters(df, "k", share).collect()}
        assert got == {k: c for k, c in n.items() if c / len(keys) > share}


def test_heavy_hitters_of_strings_nothing_and_bad_shares(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert rows(heavy_hitters(df, "k", 0.3)) == [("a", 2, 0.5)]
    assert heavy_hitters(df.limit(0), "k", 0.3).count() == 0
    for share in (0, 1.5, 1e-6):
        with pytest.raises(ValueError):
            heavy_hitters(df, "k", share)


def test_bounded_hot_keys_cut_the_hot_key(spark, hot_sales):
    got = bounded_hot_keys(hot_sales, "product_id", 16).collect()
    assert [r["product_id"] for r in got] == [1] and got[0]["_n_salts"] == 13  # 80 % of 16 parts


# --- semi-join reduction ---

@pytest.mark.parametrize("kind", ["bigint", "int", "string", "date"])
def test_reduction_keeps_every_match_and_the_join_is_equal(spark, kind):
    cast = (lambda c: F.date_add(F.lit("2020-01-01"), F.col(c).cast("int"))) if kind == "date" else (lambda c: F.col(c).cast(kind))
    fact = spark.range(-5_000, 15_000).select(cast("id").alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(None, None)], "k string, v bigint").select(cast("k").alias("k"), "v") if kind != "date"
        else spark.createDataFrame([(None, None)], "k date, v bigint"))
    dim = spark.range(-70_000, 70_000, 7).select(cast("id").alias("k"), (F.col("id") * 2).alias("w"))
    want = fact.join(dim, "k")
    assert rows(reduced_join(fact, dim, "k")) == rows(want)
    kept = reduce_to_keys(fact, dim, "k").count()
    matching = want.count()
    assert kept == matching if kind in ("bigint", "int") else matching <= kept < matching * 3


def test_sparse_whole_numbers_are_hashed_and_no_match_is_lost(spark):
    dim = spark.range(0, 2_000).select((F.col("id") * 1_000_000_007).alias("k"))
    assert key_bitmaps(dim, "k")[1] is not None
    fact = spark.range(0, 60_000).select((F.col("id") * 1_000_000_007).alias("k"))
    kept = reduce_to_keys(fact, dim, "k")
    assert kept.join(dim, "k").count() == 2_000 and kept.count() < 10_000
    narrow = reduce_to_keys(spark.range(0, 50).select(F.col("id").cast("int").alias("k")), spark.range(0, 9).withColumnRenamed("id", "k"), "k")
    assert narrow.count() == 9


def test_no_reduction_past_the_bound_or_for_other_types(spark):
    fact, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    assert reduce_to_keys(fact, dim, "k", max_bytes=100).count() == 100
    assert reduce_to_keys(fact, dim.select(F.col("k").cast("double").alias("k")), "k").count() == 100
    assert reduced_join(fact, dim, "k", max_bytes=100).count() == 5
    assert reduced_join(fact, dim.limit(0), "k").count() == 0
    assert rows(reduced_join(fact, dim, "k", "left_semi")) == [(i,) for i in range(5)]
    with pytest.raises(ValueError):
        reduced_join(fact, dim, "k", "left")


def test_only_matching_fact_rows_are_shuffled(spark):
    few = star.products(spark, SF_ORACLE).where(F.col("category") == "SMALL")
    sales = star.sales(spark, SF_ORACLE)
    matching = sales.join(few, "product_id").count()
    joined = reduced_join(sales, few, "product_id").select("sale_id", "product_name")
    written = shuffled_rows(joined)
    assert matching in written and max(written) == matching < sales.count() / 4


# --- fan-out bound ---

@pytest.mark.parametrize("eps", [0.05, 0.005])
def test_fanout_bound_is_never_below_and_within_its_error(spark, eps):
    rng = np.random.default_rng(7)
    left = spark.createDataFrame([(int(x) % 3_000,) for x in rng.zipf(1.4, 6_000)], "k int")
    right = spark.createDataFrame([(int(x) % 3_000,) for x in rng.zipf(1.2, 4_000)] + [(None,)] * 50, "k bigint")
    exact = join_fanout(left, right, "k").agg(F.sum("pairs")).first()[0]
    r = fanout_bound(left, right, "k", eps=eps).first()
    assert exact <= r["pairs_at_most"] <= float(exact) + r["error_at_most"]
    assert (r["left_rows"], r["right_rows"]) == (6_000, 4_000)


def test_fanout_bound_shuffles_one_sketch_a_task(spark):
    left = spark.range(0, 300_000, numPartitions=8).withColumnRenamed("id", "k")
    got = fanout_bound(left, spark.range(0, 400_000, numPartitions=6).withColumnRenamed("id", "k"), "k")
    assert 300_000 <= got.first()["pairs_at_most"]
    written = shuffled_rows(got)
    assert {6, 8} <= set(written)  # the others hold the counters of the two sketches, whatever the keys
    assert max(written) < 40_000
    empty = fanout_bound(left.limit(0), left, "k").first()
    assert empty["pairs_at_most"] == 0 and empty["left_rows"] == 0


def test_fanout_bound_of_strings(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    b = spark.createDataFrame([("x",), ("z",)], "j string")
    assert fanout_bound(a, b, "k", "j").first()["pairs_at_most"] == 2


# --- running totals ---

def test_running_totals_span_partitions_without_a_one_task_window(spark):
    got = scale.running_sales(spark, SF_ORACLE)
    assert "SinglePartition" not in plan_text(got)
    ranks = got.select("rank").agg(F.min("rank"), F.max("rank"), F.countDistinct("rank"), F.count("rank")).first()
    assert ranks == (1, 60_000, 60_000, 60_000)
    last = got.orderBy(F.desc("rank")).first()["running_amount"]
    whole = star.sales(spark, SF_ORACLE).agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")).first()[0]
    assert last == whole


def test_running_totals_by_a_hot_group(spark):
    random.seed(1)
    data = [("hot" if random.random() < 0.8 else random.choice(["a", "b", None]), random.randrange(10**6), i, random.choice([None, 1, 2, 5]))
            for i in range(4_000)]
    df = spark.createDataFrame(data, "g string, t int, id int, v int").repartition(7)
    out = running_totals(df, ["t", "id"], {"run": "v"}, by=["g"], totals={"run": "whole"})
    state, want = {}, {}
    for g, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        rank, run = state.get(g, (0, 0))
        state[g] = (rank + 1, run + (v or 0))
        want[i] = state[g]
    for r in out.collect():
        assert (r["rank"], r["run"], r["whole"]) == (*want[r["id"]], state[r["g"]][1])
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        placed = df.repartitionByRange("g", "t", "id").where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert placed > 4  # the hot group is not one task's


def test_running_totals_edge_cases(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, 7)], "t int, v int")
    assert rows(running_totals(df, ["t", "v"], {"s": "v"}), ["t", "v", "rank", "s"]) == [(1, 5, 2, 12), (1, 5, 3, 17), (None, 7, 1, 7)]
    assert running_totals(df.limit(0), ["t"], {"s": "v"}).count() == 0
    assert rows(running_totals(df, ["t"]), ["t", "rank"])[-1] == (None, 1)


# --- non-mergeable aggregates ---

@pytest.mark.parametrize("interpolate", [False, True])
def test_percentiles_equal_a_plain_aggregate(spark, interpolate):
    random.seed(3)
    data = [("hot" if random.random() < 0.85 else random.choice(["a", None, "one"]), random.choice([None, random.randrange(300)])) for _ in range(3_000)]
    data += [("single", 4), ("none", None)]
    df = spark.createDataFrame(data, "g string, v int").repartition(5)
    fractions = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = {r["g"]: tuple(float(r[p]) for p in fractions) for r in group_percentiles(df, ["g"], "v", fractions, interpolate).collect()}
    fn = "percentile_cont" if interpolate else "percentile_disc"
    plain = df.where("v is not null").groupBy("g").agg(*[F.expr(f"{fn}({f}) WITHIN GROUP (ORDER BY v)").alias(p) for p, f in fractions.items()])
    want = {r["g"]: tuple(float(r[p]) for p in fractions) for r in plain.collect()}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g])


def test_percentiles_refuse_bad_fractions(spark):
    with pytest.raises(ValueError):
        group_percentiles(spark.range(3), [], "id", {"x": 1.5})


def test_whole_table_percentiles_need_no_key(spark):
    got = group_percentiles(spark.range(1, 1_002), [], "id", {"median": 0.5}).first()
    assert got["median"] == 501


def test_distinct_counts_equal_and_spread(spark):
    random.seed(4)
    data = [("hot" if random.random() < 0.85 else random.choice(["a", None]), random.choice([None, random.randrange(500)]),
             random.choice([None, "x", "y", ""])) for _ in range(3_000)]
    df = spark.createDataFrame(data, "g string, v int, w string").repartition(5)
    got = rows(salted_distinct(df, ["g"], {"n_v": "v", "n_w": "w"}, n_salts=7), ["g", "n_v", "n_w"])
    assert got == rows(df.groupBy("g").agg(F.countDistinct("v").alias("n_v"), F.countDistinct("w").alias("n_w")), ["g", "n_v", "n_w"])
    assert rows(salted_distinct(df, [], {"n": "v"})) == rows(df.agg(F.countDistinct("v")))
    with pytest.raises(ValueError):
        salted_distinct(df, ["g"], {"n": "g"})
    with pytest.raises(ValueError):
        salted_distinct(df, ["g"], {"n": "v"}, n_salts=0)
