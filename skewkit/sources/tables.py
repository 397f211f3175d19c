"""Declared-schema Parquet reads (B1)."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from skewkit.schema import TABLES


def table_path(base: str, name: str) -> str:
    """``base/name.parquet`` if it exists, else ``base/name`` (a directory).

    Object-store URIs (``s3://``, ``gs://``, ``abfss://`` ...) are passed through
    to the Hadoop file system untouched; only local paths are probed.
    """
    if "://" in base and not base.startswith("file://"):
        return f"{base.rstrip('/')}/{name}.parquet"
    local = base[len("file://"):] if base.startswith("file://") else base
    single = os.path.join(local, f"{name}.parquet")
    return single if os.path.exists(single) else os.path.join(local, name)


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read Parquet with an explicit schema and an early projection.

    The projection lets Catalyst prune the scan's ``ReadSchema`` to the used
    columns; filters applied later are pushed into the scan by the optimizer.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_table(
    spark: SparkSession, base: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A driver table by name with its declared schema."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}; known: {sorted(TABLES)}")
    return read_parquet(spark, table_path(base, name), TABLES[name], columns)
