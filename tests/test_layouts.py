"""Bucketed tables, replaced partitions, Z-order clustering, compaction and incremental totals."""

import glob
import math
import os
import random
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL, plan_text, rows
from skewkit.operators.incremental import apply_batch, current_totals, fold_batches
from skewkit.plans import scale, star
from skewkit.session import scratch_path
from skewkit.sinks.layout import clustered_write, compact_files, compaction_plan, replace_partitions, write_bucketed, z_order
from skewkit.sources.files import list_files
from test_scale_operators import settings


def local(path):
    return urlparse(path).path


def files_of(path):
    return sorted(glob.glob(os.path.join(local(path), "**", "*.parquet"), recursive=True))


# --- buckets ---

def test_bucketed_join_and_aggregate_exchange_nothing(spark):
    out = scale.bucketed_order_totals(spark, SF_SMALL)
    out.collect()
    plan = plan_text(out)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_bucketed_write_has_one_file_a_bucket_and_every_row(spark):
    df = spark.range(0, 5_000).select((F.col("id") % 700).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1)], "k bigint, id bigint"))
    path = scratch_path(spark, "buckets")
    table = write_bucketed(df, "k", 6, path=path)
    assert rows(table) == rows(df) and len(files_of(path)) == 6
    counts = table.groupBy("k").count()
    counts.collect()
    assert "Exchange" not in plan_text(counts)
    with pytest.raises(ValueError):
        write_bucketed(df, "k", 0)


# --- replaced partitions ---

def test_only_the_given_days_are_replaced(spark):
    df = spark.range(0, 400).select((F.col("id") % 4).alias("day"), "id")
    path = replace_partitions(df, scratch_path(spark, "days"), ["day"])
    before = {f: os.path.getmtime(f) for f in files_of(path)}
    for _ in range(2):
        replace_partitions(df.where("day = 2").withColumn("id", -F.col("id")), path, ["day"])
    after = set(files_of(path))
    assert {f for f in before if "day=2" not in f} <= after and not {f for f in before if "day=2" in f} & after
    want = df.withColumn("id", F.when(F.col("day") == 2, -F.col("id")).otherwise(F.col("id")))
    assert rows(spark.read.parquet(path), ["day", "id"]) == rows(want, ["day", "id"])
    replace_partitions(df.limit(0), path, ["day"])
    assert spark.read.parquet(path).count() == 400


def test_the_join_prunes_partitions(spark):
    plan_of = scale.pruned_days(spark, SF_ORACLE)
    plan_of.collect()
    assert "dynamicpruning" in plan_text(plan_of)


# --- Z-order ---

def row_groups_read(path, column, low, high):
    """Files whose statistics let a range of ``column`` in."""
    n = 0
    for f in files_of(path):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = next(meta.row_group(g).column(i).statistics for i in range(meta.num_columns)
                         if meta.row_group(g).column(i).path_in_schema == column)
            n += stats is None or not (stats.max < low or stats.min > high)
    return n


def test_clustered_files_prune_on_both_columns(spark):
    sales = star.sales(spark, SF_ORACLE).select(F.to_date("sale_ts").alias("sale_date"), "product_id", "sale_id")
    plain, sorted_, z = (scratch_path(spark, n) for n in ("plain", "sorted", "z"))
    sales.repartition(16).write.parquet(plain)
    sales.repartitionByRange(16, "product_id").write.parquet(sorted_)
    clustered_write(sales, z, ["product_id", "sale_date"], files=16)
    assert rows(spark.read.parquet(z), sales.columns) == rows(sales)
    import datetime as dt
    dates = dt.date(1997, 3, 1), dt.date(1997, 3, 31)
    assert row_groups_read(plain, "product_id", 10, 19) == row_groups_read(plain, "sale_date", *dates) == 16
    assert row_groups_read(sorted_, "sale_date", *dates) == 16
    assert row_groups_read(z, "product_id", 10, 19) <= 6
    assert row_groups_read(z, "sale_date", *dates) <= 6


def test_clustered_files_end_at_the_same_keys_in_every_run(spark):
    df = spark.range(40_000).select((F.col("id") % 200).alias("a"), F.expr("id div 200").alias("b"))
    found = []
    for run in range(3):
        path = clustered_write(df, scratch_path(spark, f"edges-{run}"), ["a", "b"], files=16)
        assert rows(spark.read.parquet(path)) == rows(df)
        found.append([row_groups_read(path, c, x, x) for c in ("a", "b") for x in range(0, 200, 7)])
        assert len(files_of(path)) == 16 and max(pq.ParquetFile(f).metadata.num_rows for f in files_of(path)) <= 1.3 * 2500
    assert found[0] == found[1] == found[2] and max(found[0]) <= 5


def test_clustered_files_of_one_key_are_split(spark):
    df = spark.range(8000).select(F.when(F.col("id") % 10 > 0, F.lit(5)).otherwise(F.col("id")).alias("a"), "id")
    path = clustered_write(df, scratch_path(spark, "hot"), ["a", "id"], files=8, cuts=1)
    assert rows(spark.read.parquet(path)) == rows(df)
    assert len(files_of(path)) == 8 and max(pq.ParquetFile(f).metadata.num_rows for f in files_of(path)) <= 2000


def test_z_order_interleaves_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)] + [(None, 3)], "x int, y int")
    got = {(r["x"], r["y"]): r["z"] for r in df.withColumn("z", z_order({"x": [1, 2, 3], "y": [1, 2, 3]})).collect()}
    for (x, y), z in got.items():
        x = x or 0
        assert z == sum(((x >> b & 1) << (2 * b + 1)) | ((y >> b & 1) << (2 * b)) for b in range(2))
    for bad in ({}, {"x": []}, {"x": list(range(2**12)), "y": [1], "z": [1], "u": [1], "v": [1]}):
        with pytest.raises(ValueError):
            z_order(bad)


def test_clustering_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (None, None)], "x int, y int")
    for some in (df, df.limit(0), df.where("x IS NULL AND y IS NULL")):
        path = clustered_write(some, scratch_path(spark, "z"), ["x", "y"], files=2)
        assert rows(spark.read.schema(df.schema).parquet(path)) == rows(some)


# --- compaction ---

def test_bins_are_within_one_of_the_least_number(spark):
    random.seed(2)
    data = [(f"{d}/f{i:04}", d, random.randint(0, 99)) for d in ("a", "b", "c") for i in range({"a": 300, "b": 5, "c": 1}[d])]
    data += [("a/large", "a", 5_000), ("b/large", "b", 100)]
    files = spark.createDataFrame(data, "path string, directory string, bytes bigint")
    plan = compaction_plan(files, 100, 400).collect()
    assert {r["path"] for r in plan} == {p for p, d, n in data if n < 100 and d != "c"}
    for d in "ab":
        mine = [r for r in plan if r["directory"] == d]
        bins = {}
        for r in mine:
            bins[r["bin"]] = bins.get(r["bin"], 0) + r["bytes"]
        assert len(bins) <= math.ceil(sum(bins.values()) / 400) + 1
        assert max(bins.values()) < 400 + 100


def test_compaction_rewrites_only_small_files(spark):
    root = scratch_path(spark, "table")
    df = spark.range(0, 40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.where("id < 30000").repartition(1).write.parquet(root)
    df.where("id >= 30000").repartition(20).write.mode("append").parquet(root)
    large = max(files_of(root), key=os.path.getsize)
    stamp, total = os.path.getmtime(large), sum(os.path.getsize(f) for f in files_of(root) if f != large)
    kept = compact_files(spark, root, f"{root}-new", os.path.getsize(large), total // 3)
    assert rows(spark.read.parquet(*kept)) == rows(df)
    assert [local(p) for p in kept[:-1]] == [large] and os.path.getmtime(large) == stamp
    assert len(files_of(kept[-1])) <= 4
    assert len(files_of(root)) == 21  # readers of the old files are not disturbed


def test_nothing_to_compact(spark):
    root = scratch_path(spark, "table")
    spark.range(0, 100).repartition(1).write.parquet(root)
    kept = compact_files(spark, root, f"{root}-new", 10**9)
    assert spark.read.parquet(*kept).count() == 100 and not os.path.exists(local(f"{root}-new"))
    assert compaction_plan(list_files(spark, root), 1).count() == 0


# --- incremental totals ---

def test_totals_after_three_deltas_equal_a_full_aggregate(spark):
    random.seed(6)
    path, keys = scratch_path(spark, "totals"), ["g"]
    first = [(random.choice(["a", "b", None, "gone"]), i / 100) for i in range(500)]
    late = [(random.choice(["a", "c"]), i / 50) for i in range(100)]
    schema = "g string, amount double"
    apply_batch(spark.createDataFrame(first, schema), path, "1", keys, "amount")
    for _ in range(3):
        apply_batch(spark.createDataFrame(late, schema), path, "2", keys, "amount")
    wrong = next(x for g, x in first if g == "a")
    taken = [(g, x, -1) for g, x in first if g == "gone"] + [("a", wrong, -1), ("a", 9.99, 1)]
    apply_batch(spark.createDataFrame(taken, schema + ", sign int"), path, "3", keys, "amount", sign="sign")
    state = {}
    for g, x, s in [(g, x, 1) for g, x in first + late] + taken:
        cents, n = state.get(g, (0, 0))
        state[g] = cents + s * round(x * 100), n + s
    want = {g: (c / 100, n) for g, (c, n) in state.items() if n}
    assert "gone" not in want
    assert {r["g"]: (r["total_amount"], r["n_rows"]) for r in current_totals(spark, path, keys).collect()} == want
    folded = fold_batches(spark, path, scratch_path(spark, "folded"), keys)
    assert rows(current_totals(spark, folded, keys)) == rows(current_totals(spark, path, keys))


# --- balance and one-scan analyses ---

def test_salting_flattens_the_partitions(spark):
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="true"):
        got = {r["dealt"]: r for r in scale.partition_skew(spark, SF_ORACLE).collect()}
    assert got["key"]["largest_share"] > 0.75 and got["key and salt"]["largest_share"] < 0.15


def test_several_analyses_scan_once_and_shuffle_states_only(spark):
    from skewkit.plans import retail
    states = retail._product_and_day_states(spark, SF_ORACLE)
    n = states.count()
    assert plan_text(states).count("FileScan") == 1
    assert n == 2_000 + 2_499


def test_a_cross_join_past_the_bound_is_refused(spark):
    from skewkit.operators.joins import BROADCAST_MAX_ROWS, CrossJoinTooLarge, guarded_cross_join
    with pytest.raises(CrossJoinTooLarge):
        guarded_cross_join(spark.range(2), spark.range(BROADCAST_MAX_ROWS + 1).withColumnRenamed("id", "j"))
