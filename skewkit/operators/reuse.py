"""Managed reuse of a cached input across several analyses (B21).

Caching pays only when a DataFrame is read more than once; the context
manager refuses fewer than two consumers, materialises once, and always
releases the blocks, also when an analysis fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewkit.session import materialize


@contextmanager
def reused(df: DataFrame, consumers: int, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Persist ``df`` for ``consumers`` analyses, unpersist on exit.

    ``MEMORY_AND_DISK`` spills blocks that do not fit instead of recomputing
    them, and blocks lost with an executor are recomputed from lineage.
    """
    if consumers < 2:
        raise ValueError("caching a DataFrame used fewer than two times only costs memory")
    cached = df.persist(level)
    try:
        yield cached
    finally:
        cached.unpersist(blocking=False)


def multi_analysis(
    df: DataFrame,
    analyses: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
    columns: Mapping[str, str],
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> DataFrame:
    """Run several analyses over one persisted input; one tagged union out.

    ``columns`` maps every output column to its SQL type; an analysis that
    lacks a column gets a typed NULL there, and a leading ``analysis`` column
    holds its tag. The union is written as a table into the shared
    checkpoint folder while the input is cached, then the cache is released;
    the returned DataFrame reads that table, so it depends neither on the
    cached blocks nor on the original lineage.
    """
    with reused(df, len(analyses), level) as cached:
        return materialize(tagged_union(cached, analyses, columns), "multi-analysis")


def tagged_union(
    df: DataFrame,
    analyses: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
    columns: Mapping[str, str],
) -> DataFrame:
    """The analyses of ``df`` as one table with a leading ``analysis`` column; a column one lacks is NULL there."""
    parts = []
    for tag, fn in analyses:
        out = fn(df)
        cols = [F.lit(tag).alias("analysis")]
        for name, dtype in columns.items():
            src = F.col(name) if name in out.columns else F.lit(None)
            cols.append(src.cast(dtype).alias(name))
        parts.append(out.select(*cols))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union
