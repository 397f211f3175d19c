"""Records an event log of some retail queries, in an application of its own: logging is a launch-time setting.

    python tests/event_workload.py BASE LOG_DIR WORK_DIR
"""

import functools
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@functools.lru_cache(maxsize=2)
def recorded_log(base: str) -> str:
    log, work = tempfile.mkdtemp(prefix="skewkit-log-"), tempfile.mkdtemp(prefix="skewkit-work-")
    subprocess.run([sys.executable, os.path.abspath(__file__), base, log, work], check=True, timeout=600,
                   env=os.environ | {"PYTHONPATH": ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")})
    return log


def main(base: str, log: str, work: str) -> None:
    from skewkit.plans import retail
    from skewkit.session import local_session
    from skewkit.sinks.writers import sized_write, write_parquet

    spark = local_session(4, shuffle_partitions=8, app="skewkit-recorded", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log, "spark.eventLog.compress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    for name in ("shuffle_join_agg", "broadcast_join_agg", "skewed_agg", "salted_agg"):
        spark.sparkContext.setJobDescription(name)
        retail.QUERIES[name](spark, base).collect()
    totals = retail.category_date_totals(spark, base)
    spark.sparkContext.setJobDescription("small_files_write")
    write_parquet(totals.repartition(32), f"{work}/small_files")
    spark.sparkContext.setJobDescription("compacted_write")
    sized_write(totals, f"{work}/compacted", target_file_bytes=128 * 1024 * 1024)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
