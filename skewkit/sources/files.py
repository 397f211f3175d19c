"""File census of a table directory (B19).

Listing and sizing run as a Spark scan of the ``binaryFile`` source with
only ``path`` and ``length`` selected; the content column is pruned, so no
file body is read. It works on any Hadoop file system, not just local disk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_FILE_BYTES = 32 * 1024 * 1024


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``path, directory, bytes`` of every file matching ``glob`` under ``root``."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return files.select(
        "path",
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("directory"),
        F.col("length").alias("bytes"),
    )


def file_census(spark: SparkSession, root: str, small_file_bytes: int = SMALL_FILE_BYTES,
                glob: str = "*.parquet") -> DataFrame:
    """Per directory: files, total / mean / max bytes, and files under the floor."""
    return (
        list_files(spark, root, glob)
        .groupBy("directory")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("bytes").alias("total_bytes"),
            F.avg("bytes").alias("mean_bytes"),
            F.max("bytes").alias("max_bytes"),
            F.sum(F.when(F.col("bytes") < small_file_bytes, 1).otherwise(0)).alias("small_files"),
        )
    )
