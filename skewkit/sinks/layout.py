"""Table layouts that later reads profit from: buckets, replaced partitions, Z-order clustering, compaction."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skewkit.operators.joins import measure_side
from skewkit.operators.prefix import running_totals
from skewkit.session import materialize, scratch_path
from skewkit.sinks.writers import DEFAULT_TARGET_FILE_BYTES
from skewkit.sources.files import SMALL_FILE_BYTES, list_files

#: How far the edge of a clustered file may lie from its even share, as a part of a file's rows; edges looked up a row at most.
EDGE_SLACK, MAX_STARTS = 0.1, 256


def write_bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed", path: str | None = None) -> DataFrame:
    """``df`` written once into ``buckets`` hash buckets of ``key``, sorted inside, and read back as a catalog table.

    Joins of two such tables with equal bucket counts on their keys, and aggregates by the key, need no exchange
    however often they run. One exchange places the rows, so each bucket is one file. A key with more rows than a
    task should hold belongs in ``skew.skew_split_join`` instead: a bucket is never split.
    """
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
       .option("path", path or scratch_path(spark, table)).format("parquet").saveAsTable(table))
    return spark.table(table)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Write ``df`` partitioned by ``by``, replacing exactly the partitions it holds rows of; returns the path.

    Others stay as they are, so running a day again is idempotent. Rows are rebalanced by the partition columns: AQE
    merges small days into one task and splits a hot day over several.
    """
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))
    return path


def z_order(columns: Mapping[str, Sequence]) -> Column:
    """A key that interleaves the bits of each column's place among its ``cuts`` (ascending), first column highest.

    Rows near each other in all columns get near keys. NULL comes first.
    """
    if not columns or any(not cuts for cuts in columns.values()):
        raise ValueError("every column needs cuts")
    bits = max(math.ceil(math.log2(len(cuts) + 1)) for cuts in columns.values())
    if bits * len(columns) > 63:
        raise ValueError("too many cuts for one key")
    key = F.lit(0).cast("bigint")
    for i, (name, cuts) in enumerate(columns.items()):
        place = F.when(F.col(name).isNull(), 0).otherwise(F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda cut: cut <= F.col(name))))
        place = place.cast("bigint")
        for b in range(bits):
            at = b * len(columns) + (len(columns) - 1 - i)
            key = key.bitwiseOR(F.shiftleft(F.shiftright(place, b).bitwiseAND(F.lit(1).cast("bigint")), at))
    return key


def _file_starts(keyed: DataFrame, files: int) -> list[int]:
    """The key each file but the first starts at, from one aggregate; none where a single key reaches over an edge.

    Each is the roundest number within ``EDGE_SLACK`` of a file's rows around the even share, so files end where
    squares of the Z-order curve do and not a few cells into the next.
    """
    if not 1 < files <= MAX_STARTS:
        return []
    shares = [(i + d) / files for i in range(1, files) for d in (-EDGE_SLACK, EDGE_SLACK)]
    found = keyed.agg(F.percentile_approx("_z", shares, max(10_000, 100 * files)).alias("z")).first()["z"]
    edges = list(zip(found[::2], found[1::2]))
    if any(low >= high for low, high in edges):
        return []
    return [high >> (bit := (low ^ high).bit_length() - 1) << bit for low, high in edges]


def clustered_write(df: DataFrame, path: str, columns: Sequence[str], files: int, cuts: int = 63) -> str:
    """``df`` in ``files`` files clustered along a Z-order curve over ``columns``; returns the path.

    A filter on any of the columns then prunes row groups by their statistics, where a plain sort serves the
    first column alone. The cuts are approximate quantiles from one aggregate: they shape the files, never the rows.
    The files' edges are quantiles of the key (:func:`_file_starts`); where keys are too few or too many files are
    asked for, Spark's sampled range partitions, which also split the rows of one key.
    """
    if files < 1:
        raise ValueError("files must be >= 1")
    shares = [(i + 1) / (cuts + 1) for i in range(cuts)]
    numbers = {c: F.unix_date(F.col(c)) if df.schema[c].dataType.typeName() == "date" else F.col(c) for c in columns}
    found = df.select(*[n.alias(c) for c, n in numbers.items()]).agg(
        *[F.percentile_approx(c, shares).alias(c) for c in columns]).first()
    if any(found[c] is None for c in columns):  # nothing but NULLs
        df.write.mode("overwrite").parquet(path)
        return path
    keyed = df.withColumns({f"_z_{c}": n for c, n in numbers.items()}).withColumn(
        "_z", z_order({f"_z_{c}": sorted(set(found[c])) for c in columns}))
    starts = _file_starts(keyed, files)
    if starts:
        file = F.size(F.filter(F.array(*[F.lit(s).cast("bigint") for s in starts]), lambda start: start <= F.col("_z")))
        placed = keyed.repartitionById(files, file)
    else:
        placed = keyed.repartitionByRange(files, "_z", *columns)
    placed.sortWithinPartitions("_z", *columns).select(*df.columns).write.mode("overwrite").parquet(path)
    return path


def compaction_plan(files: DataFrame, small_file_bytes: int = SMALL_FILE_BYTES,
                    target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> DataFrame:
    """``path, directory, bytes, bin`` of the files to rewrite: each directory's small files in bins of about the target.

    ``files`` is a census (``sources.files.list_files``). Small files are laid end to end in order of their paths and cut
    at multiples of the target, so a directory gets no more bins than its small bytes over the target, rounded up. A
    directory with one small file has nothing to gain and is left out. Running sums go by
    ``prefix.running_totals``: a directory of millions of files is no single task's.
    """
    small = files.where(F.col("bytes") < small_file_bytes)
    placed = running_totals(small, ["path"], {"_upto": "bytes"}, rank=None, by=["directory"], totals={"_upto": "_all"})
    number = F.floor((F.col("_upto") - F.col("bytes")) / F.lit(target_file_bytes)).cast("bigint")
    alone = placed.groupBy("directory").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("directory")
    return placed.join(alone, "directory").select("path", "directory", "bytes", number.alias("bin"))


def compact_files(spark: SparkSession, root: str, out: str, small_file_bytes: int = SMALL_FILE_BYTES,
                  target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> list[str]:
    """Rewrite the small Parquet files under ``root`` into ``out``; returns the paths that now hold the table.

    These are the files that were large enough, untouched where they are, and the folder of the
    rewritten ones; nothing is deleted, so readers of the old list are not disturbed. One file per bin.
    """
    files = materialize(list_files(spark, root), "file-census")
    plan = materialize(compaction_plan(files, small_file_bytes, target_file_bytes), "compaction-plan")
    bins = materialize(plan.groupBy("directory", "bin").agg(F.count(F.lit(1)).alias("n")), "compaction-bins")
    numbered = running_totals(bins.select("directory", "bin"), ["directory", "bin"], rank="task")
    tasks = plan.join(numbered, ["directory", "bin"]).select(F.col("path").alias("_path"), (F.col("task") - 1).cast("int").alias("_task"))
    n = bins.count()
    kept = [r["path"] for r in files.join(plan, "path", "left_anti").select("path").collect()]
    if not n:
        return kept
    tasks = materialize(tasks, "compaction-tasks")
    rewritten = [r["_path"] for r in tasks.select("_path").collect()]
    rows = spark.read.parquet(*rewritten)
    columns = rows.columns
    rows = rows.withColumn("_path", F.col("_metadata.file_path"))
    tasks = F.broadcast(tasks) if measure_side(tasks).fits else tasks
    rows.join(tasks, "_path").repartitionById(n, F.col("_task")).select(*columns).write.mode("overwrite").parquet(out)
    return [*kept, out]
