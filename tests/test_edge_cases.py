"""Empty inputs and single rows through every operator family."""

import os
import tempfile

from skewkit.operators.aggregates import Agg, aggregate_before_join, group_aggregate
from skewkit.operators.joins import broadcast_join, join_fanout, left_outer_join, salted_join, shuffle_join
from skewkit.operators.ordering import top_k
from skewkit.operators.profile import key_distribution
from skewkit.sinks.writers import sized_write


def _tables(spark):
    fact = spark.createDataFrame([], "id long, k string, amount double")
    dim = spark.createDataFrame([("a", "x")], "k string, label string")
    one = spark.createDataFrame([(1, "a", 2.5)], "id long, k string, amount double")
    return fact, dim, one


def test_empty_fact_through_joins(spark):
    fact, dim, _ = _tables(spark)
    assert broadcast_join(fact, dim, "k").count() == 0
    assert shuffle_join(fact, dim, "k").count() == 0
    assert left_outer_join(fact, dim, "k").count() == 0
    assert salted_join(fact, dim, "k", "left", broadcast_max_rows=0).count() == 0
    assert join_fanout(fact, dim, "k").count() == 0


def test_single_row(spark):
    _, dim, one = _tables(spark)
    assert salted_join(one, dim, "k", "inner", broadcast_max_rows=0).collect()[0]["label"] == "x"
    kd = key_distribution(one, "k").collect()
    assert (kd[0]["n"], kd[0]["share"], kd[0]["ratio_to_median"]) == (1, 1.0, 1.0)
    out = aggregate_before_join(one, dim, "k", [], ["label"], [Agg("money", "amount", "t")]).collect()
    assert out[0]["t"] == 2.5
    assert top_k(one, 5, ["amount"], ["id"]).count() == 1


def test_empty_profiles_and_aggregates(spark):
    fact, _, _ = _tables(spark)
    assert key_distribution(fact, "k").count() == 0
    assert group_aggregate(fact, ["k"], [Agg("count", "*", "n")]).count() == 0


def test_empty_sized_write(spark):
    fact, _, _ = _tables(spark)
    d = tempfile.mkdtemp(prefix="skewkit-test-")
    plan = sized_write(fact, os.path.join(d, "e"), target_file_bytes=1 << 20)
    assert plan.rows == 0 and plan.files == 1
    assert spark.read.parquet(os.path.join(d, "e")).count() == 0
