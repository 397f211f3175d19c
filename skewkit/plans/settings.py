"""Session settings sized for the data, to pass at session build or submit time.

The reference toggles these on a live session; several of them (memory
fractions, executor memory) only take effect at launch, and the library
itself never changes session-wide settings. ``scale_settings`` returns a
dict for ``SparkSession.builder.config(map=...)`` or ``spark-submit --conf``.
"""

from __future__ import annotations

import math

MB = 1024 * 1024


def scale_settings(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 128 * MB,
    broadcast_threshold_bytes: int = 10 * MB,
    skew_factor: int = 5,
    skew_threshold_bytes: int = 256 * MB,
) -> dict[str, str]:
    """Shuffle and scan sizing for ``input_bytes`` of input on ``total_cores`` cores.

    * Initial shuffle partitions: enough that each holds about
      ``target_partition_bytes`` of the input (at least two waves of
      tasks); AQE then merges small partitions back to the advisory size
      and splits skewed join partitions.
    * Scan splits of ``target_partition_bytes``.
    * Planner broadcast threshold left at a small size: explicit broadcasts
      in this library are measured separately.
    """
    partitions = max(2 * total_cores, math.ceil(input_bytes / target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": str(skew_factor),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(skew_threshold_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_threshold_bytes),
    }
