"""Parquet sinks: plain overwrite (B3) and size-targeted writes (B20)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.functions.expressions import row_bytes

DEFAULT_TARGET_FILE_BYTES = 128 * 1024 * 1024


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    """``df.write.mode(mode).parquet(path)``; returns the path."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


@dataclass(frozen=True)
class WritePlan:
    rows: int
    est_bytes: int
    files: int
    max_records_per_file: int


def plan_files(df: DataFrame, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> WritePlan:
    """Number of output files from the measured rows and payload bytes.

    One aggregate job (rows, sum of row widths); files = ceil(bytes/target),
    at least one. The byte estimate is the uncompressed payload,
    so compressed files come out smaller than the target: it bounds the
    file size from above and never produces more files than needed.
    """
    width = row_bytes(df.schema)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    rows, est = int(row["n"]), int(row["b"])
    files = max(1, math.ceil(est / max(1, target_file_bytes)))
    per_file = max(1, math.ceil(rows / files)) if rows else 1
    return WritePlan(rows, est, files, per_file)


def sized_write(
    df: DataFrame,
    path: str,
    target_file_bytes: int | None = None,
    mode: str = "overwrite",
    cluster_by: Sequence[str] = (),
    files: int | None = None,
) -> WritePlan | None:
    """Write ``df`` as files of about a target size instead of one per shuffle partition.

    Default (``target_file_bytes=None``): one pass. A ``rebalance`` hint adds
    a shuffle whose partitions AQE splits or merges to its advisory size from
    the real shuffle statistics, so each write task gets about that much
    data; with ``cluster_by`` rows of equal keys stay together and are sorted
    inside each file. No rows are counted beforehand.

    With an explicit ``target_file_bytes``: measure first (one aggregate pass,
    see :func:`plan_files`), then ``repartition(n)`` (balanced; unlike
    ``coalesce(n)`` it does not shrink the parallelism of the stage computing
    ``df``) or range-partition on ``cluster_by``; ``maxRecordsPerFile`` caps
    every file even when the estimate was low. This computes ``df`` twice;
    use it for small or cheap inputs.

    With ``files``: exactly that many write tasks (one file each, none
    empty unless there are fewer rows), by a balanced ``repartition(files)``
    or a range partitioning on ``cluster_by``; one pass, no measuring.
    """
    if files is not None:
        if files < 1:
            raise ValueError("files must be >= 1")
        out = (df.repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by) if cluster_by
               else df.repartition(files))
        out.write.mode(mode).parquet(path)
        return None
    if target_file_bytes is None:
        out = df.hint("rebalance", *cluster_by)
        if cluster_by:
            out = out.sortWithinPartitions(*cluster_by)
        out.write.mode(mode).parquet(path)
        return None
    plan = plan_files(df, target_file_bytes)
    if cluster_by:
        out = df.repartitionByRange(plan.files, *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        out = df.repartition(plan.files)
    (out.write.mode(mode)
        .option("maxRecordsPerFile", max(plan.max_records_per_file * 2, 1))
        .parquet(path))
    return plan
