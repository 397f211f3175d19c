import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from skewkit.functions.expressions import money_sum
from skewkit.operators.aggregates import Agg, count_by, group_aggregate, salted_aggregate

AGGS = (Agg("money", "amount", "total"), Agg("count", "*", "n"), Agg("count", "q", "nq"),
        Agg("sum", "q", "sq"), Agg("min", "q", "mn"), Agg("max", "q", "mx"), Agg("avg", "q", "aq"))


def _df(spark, n=3000):
    rnd = random.Random(7)
    data = []
    for i in range(n):
        k = "PROMO_ESPECIAL" if i % 10 < 8 else rnd.choice(["PRODUTO_A", "", None])
        q = None if i % 13 == 0 else rnd.randint(0, 99)
        data.append((i, k, round(rnd.uniform(0, 1000), 2), q))
    return spark.createDataFrame(data, "id long, k string, amount double, q int")


@pytest.mark.parametrize("n_salts", [1, 2, 10, 64])
def test_salted_equals_direct(spark, n_salts):
    df = _df(spark)
    a = group_aggregate(df, ["k"], AGGS)
    b = salted_aggregate(df, ["k"], AGGS, n_salts=n_salts)
    cols = [x.alias for x in AGGS]
    ra, rb = rows(a, ["k"] + cols), rows(b, ["k"] + cols)
    assert [r[:-1] for r in ra] == [r[:-1] for r in rb]
    for x, y in zip(ra, rb):
        assert x[-1] == pytest.approx(y[-1], rel=1e-12)


def test_repartitioning_input_changes_nothing(spark):
    df = _df(spark)
    a = group_aggregate(df, ["k"], AGGS[:3])
    b = group_aggregate(df.repartition(13), ["k"], AGGS[:3])
    assert rows(a) == rows(b)


def test_empty_input(spark):
    df = _df(spark).limit(0)
    assert group_aggregate(df, ["k"], AGGS).count() == 0
    assert salted_aggregate(df, ["k"], AGGS).count() == 0


def test_money_sum_is_exact(spark):
    rnd = random.Random(3)
    vals = [round(rnd.uniform(0, 100000), 2) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(money_sum("x").alias("t")).first()["t"]
    assert got == float(sum(Decimal(str(v)) for v in vals))


def test_count_by_labels_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "SP"), (3, None), (4, "")], "id long, region string")
    out = {r["region"]: r["n"] for r in count_by(df, "region", "id", "n", "UNKNOWN").collect()}
    assert out == {"UNKNOWN": 2, "SP": 1, "": 1}


def test_unsupported_aggregate():
    with pytest.raises(ValueError):
        Agg("median", "x", "m")


def test_grouping_set_summaries_equal_separate_group_bys(spark):
    from skewkit.operators.aggregates import grouping_set_summaries

    df = _df(spark).withColumn("g", F.col("id") % 3)
    out = grouping_set_summaries(df, [
        ("by_k", ["k"], [Agg("count", "*", "n"), Agg("money", "amount", "total")]),
        ("by_g", ["g"], [Agg("count", "*", "n")]),
    ], {"k": "string", "g": "bigint", "n": "bigint", "total": "double"})
    got = {(r["analysis"], r["k"], r["g"]): (r["n"], r["total"]) for r in out.collect()}
    for r in group_aggregate(df, ["k"], [Agg("count", "*", "n"), Agg("money", "amount", "total")]).collect():
        assert got[("by_k", r["k"], None)] == (r["n"], r["total"])  # NULL data key kept apart from the set tag
    for r in group_aggregate(df, ["g"], [Agg("count", "*", "n")]).collect():
        assert got[("by_g", None, r["g"])] == (r["n"], None)
    assert len(got) == df.select("k").distinct().count() + 3


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a_b", "", "PROMO_ESPECIAL", None]),
                  st.integers(min_value=0, max_value=10**7).map(lambda c: c / 100),
                  st.one_of(st.none(), st.integers(min_value=-5, max_value=99))),
        max_size=60),
    n_salts=st.integers(min_value=1, max_value=9),
)
def test_salted_aggregate_property(spark, data, n_salts):
    df = spark.createDataFrame([(i,) + r for i, r in enumerate(data)], "id long, k string, amount double, q int")
    aggs = AGGS[:-1]  # avg compared separately above (floating point)
    cols = ["k"] + [a.alias for a in aggs]
    assert rows(salted_aggregate(df, ["k"], aggs, n_salts=n_salts), cols) == rows(group_aggregate(df, ["k"], aggs), cols)


@pytest.mark.parametrize("duplicate_dim_key", [False, True])
def test_aggregate_before_join_equals_join_then_aggregate(spark, duplicate_dim_key):
    from skewkit.operators.aggregates import aggregate_before_join
    from skewkit.operators.joins import shuffle_join

    fact = _df(spark).withColumn("p", F.col("id") % 17).withColumn("flag", F.col("id") % 3)
    dims = [(i, f"cat{i % 4}") for i in range(15)]  # keys 15, 16 have no dimension row
    if duplicate_dim_key:
        dims += [(1, "cat1"), (2, "other")]  # same category twice, and a second category
    dim = spark.createDataFrame(dims, "p long, category string")
    aggs = AGGS[:-1]
    want = group_aggregate(fact.join(dim, "p"), ["p", "category", "flag"], aggs)
    cols = ["p", "category", "flag"] + [a.alias for a in aggs]
    for join in (None, shuffle_join):
        got = aggregate_before_join(fact, dim, "p", ["flag"], ["category"], aggs, join)
        assert rows(got, cols) == rows(want, cols)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("duplicate_dim_key", [False, True])
def test_aggregate_before_join_bounds_the_groups_of_a_task(spark, monkeypatch, duplicate_dim_key, broadcast):
    from functools import partial

    from skewkit.operators import aggregates, joins

    monkeypatch.setattr(aggregates, "GROUPS_PER_TASK", 50, raising=False)
    if not broadcast:
        monkeypatch.setattr(joins, "broadcast_join", partial(joins.broadcast_join, max_rows=0))
    fact = spark.range(3000).select(
        F.when(F.col("id") % 19 > 0, F.col("id") % 17).alias("p"), F.when(F.col("id") % 23 > 0, F.expr("id div 2")).alias("day"),
        (F.col("id") % 100 / 4).alias("amount"), F.when(F.col("id") % 5 > 0, (F.col("id") % 7).cast("int")).alias("q"),
        (F.col("id") % 9).cast("decimal(9,2)").alias("d"))
    dims = [(i, f"cat{i % 4}" if i else None) for i in range(15)] + [(None, "none")]
    if duplicate_dim_key:
        dims += [(1, "cat1"), (2, "other"), (0, None)]
    dim = spark.createDataFrame(dims, "p long, category string")
    aggs = [Agg("money", "amount", "money"), Agg("count", "*", "n"), Agg("count", "q", "n_q"), Agg("avg", "q", "mean"),
            Agg("sum", "d", "total"), Agg("min", "q", "low"), Agg("max", "amount", "high")]
    want = group_aggregate(fact.join(dim, "p"), ["p", "category", "day"], aggs)
    got = aggregates.aggregate_before_join(fact, dim, "p", ["day"], ["category"], aggs)
    assert rows(got, want.columns) == rows(want)
    held = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) > 2000 and max(held) <= 5 * 50
    few = fact.withColumn("day", F.col("day") % 3)
    got = aggregates.aggregate_before_join(few, dim, "p", ["day"], ["category"], aggs)
    assert rows(got, want.columns) == rows(group_aggregate(few.join(dim, "p"), ["p", "category", "day"], aggs))


def test_salted_aggregate_hot_groups_only(spark):
    from skewkit.operators.aggregates import hot_groups

    df = _df(spark)
    hot = hot_groups(df, ["k"], rows_per_salt=400)
    got_hot = {r["k"]: r["_n_salts"] for r in hot.collect()}
    assert set(got_hot) == {"PROMO_ESPECIAL"} and got_hot["PROMO_ESPECIAL"] == 6  # 2400 rows / 400
    aggs = AGGS[:-1]
    cols = ["k"] + [a.alias for a in aggs]
    assert rows(salted_aggregate(df, ["k"], aggs, hot=hot), cols) == rows(group_aggregate(df, ["k"], aggs), cols)
