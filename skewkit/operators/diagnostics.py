"""Event-log diagnostics (B23–B29): the questions asked of a slow job, as
grouped DataFrame queries over the tables of :mod:`skewkit.sources.eventlog`.

All of them group tasks by (application, stage) or by run first, so the
work is one distributed aggregation over the task rows however many logs
are read; per-stage windows only ever span the executors or stages of one
application.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ACC = 10_000
MB = 1024 * 1024


def _median(c: str | Column) -> Column:
    return F.percentile_approx(c, 0.5, _ACC)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def stage_descriptions(jobs: DataFrame) -> DataFrame:
    """(app, stage) → description of the first job that ran the stage."""
    return jobs.where(F.col("stage_id").isNotNull()).groupBy("app_id", "stage_id").agg(
        F.min_by("description", "job_id").alias("description"))


def _with_description(df: DataFrame, jobs: DataFrame | None) -> DataFrame:
    if jobs is None:
        return df.withColumn("description", F.lit(None).cast("string"))
    return df.join(stage_descriptions(jobs), ["app_id", "stage_id"], "left")


# --- B23 ---------------------------------------------------------------------

def applications_summary(applications: DataFrame, tasks: DataFrame) -> DataFrame:
    """Application list: name, start, duration, stages, tasks, failed tasks."""
    per_app = tasks.groupBy("app_id").agg(
        F.countDistinct("stage_id", "stage_attempt").alias("stages"),
        F.count(F.lit(1)).alias("tasks"),
        F.sum(F.col("failed").cast("int")).cast("long").alias("failed_tasks"),
    )
    return applications.join(per_app, "app_id", "left")


# --- Per-stage summary (one aggregation feeding B24–B27 and B29) -----------

_STAGE = ["app_id", "stage_id", "stage_attempt"]


def stage_summary(tasks: DataFrame) -> DataFrame:
    """Every per-stage metric of the diagnostics from one aggregation over the tasks.

    Conditional aggregates keep the task subsets apart: skew uses finished
    (neither failed nor killed) tasks, write sizes the tasks that wrote rows. Records of a
    task are rows read from files plus rows read from shuffle.
    """
    ok = ~F.col("failed") & ~F.col("killed")
    rec = F.coalesce(F.col("input_records"), F.lit(0)) + F.coalesce(F.col("shuffle_read_records"), F.lit(0))
    ok_rec = F.when(ok, rec)
    writing = ok & (F.col("output_records") > 0)
    out = tasks.groupBy(*_STAGE).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum(F.col("failed").cast("int")).cast("long").alias("failed_tasks"),
        F.sum(F.when(F.col("end_reason") == "ExecutorLostFailure", 1).otherwise(0)).cast("long")
        .alias("executor_lost_tasks"),
        F.sum("input_bytes").alias("input_bytes"),
        F.sum("shuffle_read_bytes").alias("shuffle_read_bytes"),
        F.sum("shuffle_read_records").alias("shuffle_read_records"),
        F.sum("shuffle_write_bytes").alias("shuffle_write_bytes"),
        F.sum("shuffle_write_records").alias("shuffle_write_records"),
        F.sum(ok.cast("int")).cast("long").alias("ok_tasks"),
        F.max(F.when(ok, F.col("duration_ms"))).alias("max_duration_ms"),
        _median(F.when(ok, F.col("duration_ms"))).alias("median_duration_ms"),
        F.max(ok_rec).alias("max_records"),
        _median(F.when(ok & (rec > 0), rec)).alias("median_records"),
        F.sum(ok_rec).alias("total_records"),
        F.sum("memory_spilled").alias("memory_spilled"),
        F.sum("disk_spilled").alias("disk_spilled"),
        F.sum("gc_time_ms").alias("gc_time_ms"),
        F.sum("run_time_ms").alias("run_time_ms"),
        F.max("peak_execution_memory").alias("max_peak_execution_memory"),
        F.sum(writing.cast("int")).cast("long").alias("write_tasks"),
        F.sum(F.when(writing, F.col("output_bytes"))).alias("output_bytes"),
        F.sum(F.when(writing, F.col("output_records"))).alias("output_records"),
        F.avg(F.when(writing, F.col("output_bytes"))).alias("mean_bytes_per_task"),
        F.min(F.when(writing, F.col("output_bytes"))).alias("min_bytes_per_task"),
    )
    return out.select(
        "*",
        _ratio(F.col("max_duration_ms"), F.col("median_duration_ms")).alias("time_ratio"),
        _ratio(F.col("max_records"), F.col("median_records")).alias("records_ratio"),
        _ratio(F.col("max_records"), F.col("total_records")).alias("largest_task_share"),
        _ratio(F.col("gc_time_ms"), F.col("run_time_ms")).alias("gc_share"),
    )


# --- B24 ---------------------------------------------------------------------

def shuffle_by_stage(tasks: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Shuffle read/write bytes and records per stage, ranked by shuffle written.

    Answers "which stage moves most data" and, filtered to one description,
    "is the shuffle gone".
    """
    per_stage = stage_summary(tasks).select(
        *_STAGE, "tasks", "input_bytes", "shuffle_read_bytes", "shuffle_read_records",
        "shuffle_write_bytes", "shuffle_write_records")
    w = Window.partitionBy("app_id").orderBy(F.col("shuffle_write_bytes").desc(), F.col("stage_id"),
                                             F.col("stage_attempt"))
    return _with_description(per_stage, jobs).withColumn("write_rank", F.row_number().over(w))


# --- B25 ---------------------------------------------------------------------

_SKEW_COLS = ["max_duration_ms", "median_duration_ms", "max_records", "median_records", "total_records",
              "time_ratio", "records_ratio", "largest_task_share"]


def task_skew(tasks: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Per stage: slowest vs median task, largest vs median task input (finished tasks).

    ``time_ratio`` of 10 is the "one task ten times slower" symptom. The
    median record count is taken over tasks that read anything, since a
    hash partitioning of few keys leaves many tasks empty.
    """
    out = stage_summary(tasks).where(F.col("ok_tasks") > 0).select(
        *_STAGE, F.col("ok_tasks").alias("tasks"), *_SKEW_COLS)
    return _with_description(out, jobs)


def executor_load(tasks: DataFrame) -> DataFrame:
    """Per (stage, executor): tasks, records, run time and share of the stage's records."""
    rec = F.coalesce(F.col("input_records"), F.lit(0)) + F.coalesce(F.col("shuffle_read_records"), F.lit(0))
    per = tasks.withColumn("records", rec).groupBy(*_STAGE, "executor_id").agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum("records").alias("records"),
        F.sum("run_time_ms").alias("run_time_ms"),
    )
    w = Window.partitionBy(*_STAGE)
    return per.select(
        "*",
        _ratio(F.col("records"), F.sum("records").over(w)).alias("records_share"),
        _ratio(F.col("run_time_ms"), F.sum("run_time_ms").over(w)).alias("time_share"),
    )


# --- B26 ---------------------------------------------------------------------

_MEMORY_COLS = ["memory_spilled", "disk_spilled", "gc_time_ms", "run_time_ms", "max_peak_execution_memory",
                "failed_tasks", "executor_lost_tasks", "gc_share"]


def _executors_removed(summary: DataFrame, executors: DataFrame | None) -> DataFrame:
    if executors is None:
        return summary.withColumn("executors_removed", F.lit(0).cast("long"))
    removed = executors.where(F.col("change") == "removed").groupBy("app_id").agg(
        F.count(F.lit(1)).alias("executors_removed"))
    return summary.join(removed, "app_id", "left").fillna({"executors_removed": 0})


def memory_pressure(tasks: DataFrame, executors: DataFrame | None = None) -> DataFrame:
    """Per stage: memory and disk spill (kept apart), GC share, failures.

    ``executors_removed`` counts executor losses of the whole application.
    """
    return _executors_removed(stage_summary(tasks).select(*_STAGE, *_MEMORY_COLS), executors)


# --- B27 ---------------------------------------------------------------------

_WRITE_COLS = ["write_tasks", "output_bytes", "output_records", "mean_bytes_per_task", "min_bytes_per_task"]


def write_sizes(tasks: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Per writing stage: tasks that wrote, bytes and records, mean bytes per writing task.

    Each writing task produces at least one file, so a small mean is the
    small-files symptom.
    """
    out = stage_summary(tasks).where(F.col("write_tasks") > 0).select(*_STAGE, *_WRITE_COLS)
    return _with_description(out, jobs)


# --- B28 ---------------------------------------------------------------------

_TOTALS = ("tasks", "shuffle_read_bytes", "shuffle_write_bytes", "memory_spilled", "disk_spilled",
           "gc_time_ms", "run_time_ms", "output_bytes", "failed_tasks")


def run_totals(tasks: DataFrame, jobs: DataFrame | None = None, by: str = "app_id") -> DataFrame:
    """Totals per run; a run is an application (``by="app_id"``) or a job description."""
    src = tasks
    if by == "description":
        if jobs is None:
            raise ValueError("grouping by description needs the jobs table")
        src = _with_description(tasks, jobs)
    return src.groupBy(F.col(by).alias("run")).agg(
        F.count(F.lit(1)).alias("tasks"),
        F.sum("shuffle_read_bytes").alias("shuffle_read_bytes"),
        F.sum("shuffle_write_bytes").alias("shuffle_write_bytes"),
        F.sum("memory_spilled").alias("memory_spilled"),
        F.sum("disk_spilled").alias("disk_spilled"),
        F.sum("gc_time_ms").alias("gc_time_ms"),
        F.sum("run_time_ms").alias("run_time_ms"),
        F.sum("output_bytes").alias("output_bytes"),
        F.sum(F.col("failed").cast("int")).cast("long").alias("failed_tasks"),
    )


def compare_runs(totals: DataFrame, before: str, after: str) -> DataFrame:
    """Two runs side by side: ``metric, before, after, ratio (after / before)``."""
    pair = totals.where(F.col("run").isin(before, after))
    stacked = pair.select(
        "run",
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in _TOTALS
        ])).alias("kv"),
    ).select("run", "kv.metric", "kv.value")
    wide = stacked.groupBy("metric").agg(
        F.max(F.when(F.col("run") == before, F.col("value"))).alias("before"),
        F.max(F.when(F.col("run") == after, F.col("value"))).alias("after"),
    )
    return wide.withColumn("ratio", _ratio(F.col("after"), F.col("before")))


# --- B29 ---------------------------------------------------------------------

@dataclass(frozen=True)
class Thresholds:
    shuffle_write_bytes: int = 256 * MB
    skew_time_ratio: float = 10.0
    skew_records_ratio: float = 10.0
    skew_min_duration_ms: int = 1_000
    skew_min_tasks: int = 4
    skew_task_share: float = 0.5
    gc_share: float = 0.10
    small_file_bytes: int = 32 * MB
    small_files_min_tasks: int = 2


def findings(
    tasks: DataFrame,
    jobs: DataFrame | None = None,
    executors: DataFrame | None = None,
    t: Thresholds = Thresholds(),
) -> DataFrame:
    """Rule hits: ``app_id, stage_id, description, finding, evidence, advice``.

    Each rule is a predicate over the rows of :func:`stage_summary` (one
    aggregation over the tasks, whose exchange the branches share); the
    result is their union, one row per (stage, finding). ``executors`` is
    accepted for symmetry with :func:`memory_pressure`; executor losses show
    in the tasks as ``ExecutorLostFailure``.
    """
    cols = ["app_id", "stage_id", "description", "finding", "evidence", "advice"]

    def rule(cond: Column, name: str, evidence: Column, advice: str) -> DataFrame:
        return st.where(cond).select(
            "app_id", "stage_id", "description", F.lit(name).alias("finding"),
            evidence.alias("evidence"), F.lit(advice).alias("advice"))

    # one aggregation over the tasks; every rule is a predicate on its rows
    st = _with_description(stage_summary(tasks), jobs)
    parts = [
        rule(F.col("shuffle_write_bytes") >= t.shuffle_write_bytes, "large_shuffle",
             F.format_string("shuffle write %d bytes in %d tasks", "shuffle_write_bytes", "tasks"),
             "broadcast the small join side (size-checked) or aggregate before the join"),
        rule((F.col("ok_tasks") >= t.skew_min_tasks)
             & (((F.col("time_ratio") >= t.skew_time_ratio) & (F.col("max_duration_ms") >= t.skew_min_duration_ms))
                | (F.col("records_ratio") >= t.skew_records_ratio)
                | (F.col("largest_task_share") >= t.skew_task_share)),
             "task_skew",
             F.format_string("slowest task %.1fx median, largest input %.1fx median, %.0f%% of the stage",
                             F.coalesce("time_ratio", F.lit(0.0)), F.coalesce("records_ratio", F.lit(0.0)),
                             F.coalesce(F.col("largest_task_share"), F.lit(0.0)) * 100),
             "salt the hot keys (salted_join / salted_aggregate) or let AQE split skewed join partitions"),
        rule(F.col("disk_spilled") > 0, "disk_spill",
             F.format_string("disk spill %d bytes, memory spill %d bytes", "disk_spilled", "memory_spilled"),
             "use more, smaller partitions or more memory per task; cache only reused inputs"),
        rule(F.col("gc_share") >= t.gc_share, "gc_pressure",
             F.format_string("GC %.0f%% of run time", F.col("gc_share") * 100),
             "cache less or with MEMORY_AND_DISK; reduce per-task state"),
        rule(F.col("failed_tasks") > 0, "failed_tasks",
             F.format_string("%d failed tasks, %d lost with executors", "failed_tasks", "executor_lost_tasks"),
             "check executor memory and the failure reasons of the tasks"),
        rule((F.col("write_tasks") >= t.small_files_min_tasks)
             & (F.col("mean_bytes_per_task") < t.small_file_bytes), "small_files",
             F.format_string("%d writing tasks, mean %.0f bytes", "write_tasks", "mean_bytes_per_task"),
             "write with sized_write (repartition to bytes / target files)"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*cols)
