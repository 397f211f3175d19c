"""Ordering: global sort (last step only), top-k, and partition-local sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(by_desc: Sequence[str], tie_asc: Sequence[str]) -> list[Column]:
    # desc() puts NULLs last, asc() first; the ascending tie-break columns make
    # the order total so equal values are ordered the same on every run.
    return [F.col(c).desc() for c in by_desc] + [F.col(c).asc() for c in tie_asc]


def ranked(df: DataFrame, by_desc: Sequence[str], tie_asc: Sequence[str] = ()) -> DataFrame:
    """Globally ordered rows (range exchange + sort).

    Meant as the last step of a query: a sort placed before a join or an
    aggregate is removed by the optimizer and costs a shuffle for nothing.
    """
    return df.orderBy(*_order(by_desc, tie_asc))


def top_k(df: DataFrame, k: int, by_desc: Sequence[str], tie_asc: Sequence[str] = ()) -> DataFrame:
    """The ``k`` first rows in that order.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: each task keeps its
    own k best rows, then k x tasks rows are merged, with no full sort.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.orderBy(*_order(by_desc, tie_asc)).limit(k)


def sort_within_partitions(
    df: DataFrame,
    sort_cols: Sequence[str],
    partition_cols: Sequence[str] = (),
    num_partitions: int | None = None,
) -> DataFrame:
    """Rows sorted inside each partition, no total order.

    Without ``partition_cols`` there is no exchange at all. With them the
    rows are first range-partitioned on ``partition_cols + sort_cols`` (one
    sampled shuffle), e.g. to cluster a file layout: each partition covers a
    narrow range of the keys, and a key too large for one partition is split
    by its sort values over several, where hash partitioning would put all
    of it (or all NULL keys) into one task.
    """
    out = df
    if partition_cols:
        keys = list(partition_cols) + [c for c in sort_cols if c not in partition_cols]
        out = (out.repartitionByRange(num_partitions, *keys) if num_partitions
               else out.repartitionByRange(*keys))
    return out.sortWithinPartitions(*sort_cols)
