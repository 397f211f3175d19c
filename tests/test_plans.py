"""Physical-plan shape of registered queries (the scale properties, not just the rows)."""

import re

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL, plan_text

from skewkit.plans import retail, scale

RETAIL = list(retail.QUERIES | scale.QUERIES)


def _plan(spark, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    df.collect()
    return plan_text(df)


def test_flagship_broadcasts_and_shuffles_once(spark):
    final = _plan(spark, "sales_summary").split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final
    assert len(re.findall(r"Exchange hashpartitioning", final)) == 1


def test_scan_prunes_columns(spark):
    p = _plan(spark, "sales_summary")
    for unused in ("l_tax", "l_discount", "l_suppkey", "l_linestatus", "p_brand", "p_retailprice"):
        assert unused not in p


def test_shuffle_variant_uses_merge_join(spark):
    assert "SortMergeJoin" in _plan(spark, "shuffle_join_agg")


@pytest.mark.parametrize("name", ["null_key_left_join", "left_outer_summary"])
def test_left_joins_broadcast_the_small_side(spark, name):
    p = _plan(spark, name)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_local_sort_has_no_exchange(spark):
    assert "Exchange" not in _plan(spark, "sorted_within_partitions")


def test_clustering_uses_range_partitioning(spark):
    from skewkit.operators.ordering import sort_within_partitions
    from skewkit.plans import star

    df = sort_within_partitions(star.sales(spark, SF_SMALL), ["flag", "amount"], partition_cols=["flag"])
    assert "rangepartitioning" in plan_text(df)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top_products")


@pytest.mark.parametrize("name", RETAIL)
def test_no_cartesian_product(spark, name):
    assert "CartesianProduct" not in _plan(spark, name)
