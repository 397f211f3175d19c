"""Spark event logs as typed tables (B22).

An event log is newline JSON with one listener event per line; a folder may
hold many applications, as single files (``<app-id>[.codec]``) or rolled
folders (``eventlog_v2_<app-id>/events_<n>_<app-id>[.codec]``). Reads use an
explicit schema holding only the fields the diagnostics need: inference
would scan every file twice and drift across Spark versions, while with a
schema an absent field is simply NULL. Each row keeps the application id
taken from its file path, so events of many applications can be read in one
distributed scan without a join to the start events.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, S, B = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TASK_INFO = _s(
    ("Task ID", L), ("Index", I), ("Attempt", I), ("Partition ID", I), ("Launch Time", L),
    ("Executor ID", S), ("Host", S), ("Locality", S), ("Speculative", B), ("Finish Time", L),
    ("Failed", B), ("Killed", B),
)
TASK_METRICS = _s(
    ("Executor Run Time", L), ("Executor CPU Time", L), ("JVM GC Time", L), ("Peak Execution Memory", L),
    ("Memory Bytes Spilled", L), ("Disk Bytes Spilled", L), ("Result Size", L),
    ("Input Metrics", _s(("Bytes Read", L), ("Records Read", L))),
    ("Output Metrics", _s(("Bytes Written", L), ("Records Written", L))),
    ("Shuffle Read Metrics", _s(("Remote Bytes Read", L), ("Local Bytes Read", L), ("Total Records Read", L),
                                ("Fetch Wait Time", L))),
    ("Shuffle Write Metrics", _s(("Shuffle Bytes Written", L), ("Shuffle Records Written", L),
                                 ("Shuffle Write Time", L))),
)
END_REASON = _s(("Reason", S), ("Class Name", S), ("Description", S), ("Loss Reason", S),
                ("Exit Caused By App", B))
STAGE_INFO = _s(
    ("Stage ID", I), ("Stage Attempt ID", I), ("Stage Name", S), ("Number of Tasks", I),
    ("Submission Time", L), ("Completion Time", L), ("Failure Reason", S),
)
EVENT_SCHEMA = _s(
    ("Event", S),
    ("App Name", S), ("App ID", S), ("Timestamp", L), ("User", S),
    ("Stage ID", I), ("Stage Attempt ID", I), ("Task Type", S),
    ("Task End Reason", END_REASON), ("Task Info", TASK_INFO), ("Task Metrics", TASK_METRICS),
    ("Stage Info", STAGE_INFO),
    ("Job ID", I), ("Submission Time", L), ("Completion Time", L), ("Stage IDs", T.ArrayType(I)),
    ("Job Result", _s(("Result", S))),
    ("Properties", T.MapType(S, S)),
    ("Executor ID", S), ("Removed Reason", S), ("Executor Info", _s(("Host", S), ("Total Cores", I))),
)

# Rolled logs live in eventlog_v2_<app>/; single-file logs are named <app>
# with an optional codec and ".inprogress" suffix.
_ROLLED = r"eventlog_v2_([^/]+)/[^/]*$"
_SINGLE = r"([^/]+?)(\.(lz4|lzf|snappy|zstd|zst))?(\.inprogress)?$"


def _app_from_path(path: Column) -> Column:
    rolled = F.regexp_extract(path, _ROLLED, 1)
    return F.when(rolled != "", rolled).otherwise(F.regexp_extract(path, _SINGLE, 1))


# The file name tells Spark's text sources the codec; a compacted file's extra suffix hides it from them.
_COMPACT = r"\.compact$"


def _decode_log_files(batches):
    """mapInPandas body for compacted zstd logs: files → (path, line) rows; damage raises."""
    import io

    import pandas as pd
    import zstandard

    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            if not re.search(r"\.zstd?\.compact$", path):
                raise ValueError(f"{path}: of compacted event logs only zstd ones can be read")
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(bytes(content)), read_across_frames=True)
            lines = io.TextIOWrapper(raw, encoding="utf-8").read().splitlines()
            yield pd.DataFrame({"path": path, "line": lines})


def decode_log_files(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows (``path, content``) → ``(path, line)`` rows."""
    return files.select("path", "content").mapInPandas(_decode_log_files, "path string, line string")


def _local_root(path: str) -> str | None:
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return None if "://" in path else path


def _list_log_files(spark: SparkSession, roots: list[str]) -> list[str]:
    """Non-empty, non-hidden files under ``roots``.

    Local folders are walked on the driver (instant); any other file system
    is listed by Spark itself through the ``binaryFile`` source with the
    content column pruned.
    """
    local = [_local_root(r) for r in roots]
    if all(r is not None for r in local):
        out = []
        for r in local:
            for d, _, files in os.walk(r):
                out += [os.path.join(d, f) for f in sorted(files)
                        if not f.startswith((".", "_")) and os.path.getsize(os.path.join(d, f)) > 0]
        return out
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(roots)
               .select("path", "length").where(F.col("length") > 0))
    return [r["path"] for r in listing.select("path").collect()]


def _checked(events: DataFrame) -> DataFrame:
    """Fail on a line that does not parse, unless its log is still being written (its last line may be cut)."""
    damaged = F.raise_error(F.concat(F.lit("damaged event log: "), F.col("_path")))
    readable = F.when(F.col("Event").isNotNull(), True).when(F.col("_path").endswith(".inprogress"), False).otherwise(damaged)
    return events.where(readable)


def incomplete_applications(events: DataFrame) -> DataFrame:
    """Applications without an end event: still running, or their log was cut."""
    ended = F.max((F.col("Event") == "SparkListenerApplicationEnd").cast("int"))
    return events.groupBy("app_id").agg(ended.alias("ended")).where("ended = 0").select("app_id")


def read_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All events under ``path`` with ``app_id``.

    Logs go through Spark's JSON reader with the explicit schema, compressed ones
    as well; only compacted files, whose names hide their codec, are decoded in a
    ``mapInPandas`` step. A finished log (no ``.inprogress``) must be whole: a line
    that does not parse, or no end of application, is an error. A log still being
    written may lack its last line. The application id is the one its start
    event names, else that of the path.
    """
    roots = [path] if isinstance(path, str) else list(path)
    paths = _list_log_files(spark, roots)
    plain = [p for p in paths if not re.search(_COMPACT, p)]
    packed = [p for p in paths if re.search(_COMPACT, p)]
    parts = []
    if plain:
        parts.append(spark.read.schema(EVENT_SCHEMA).json(plain).withColumn("_path", F.col("_metadata.file_path")))
    if packed:
        lines = decode_log_files(spark.read.format("binaryFile").load(packed))
        parts.append(lines.select(F.from_json("line", EVENT_SCHEMA).alias("e"), F.col("path").alias("_path")).select("e.*", "_path"))
    if not parts:
        return spark.createDataFrame([], EVENT_SCHEMA).withColumn("app_id", F.lit(None).cast("string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = _checked(out).withColumn("app_id", _app_from_path(F.col("_path")))
    open_apps = {_app_of(p) for p in paths if p.endswith(".inprogress")}
    cut = [r["app_id"] for r in incomplete_applications(out).where(~F.col("app_id").isin(*open_apps) if open_apps else F.lit(True)).limit(5).collect()]
    if cut:
        raise ValueError(f"event logs without an end of application, though finished by name: {cut}")
    named = out.where(F.col("Event") == "SparkListenerApplicationStart").groupBy("app_id").agg(F.max("App ID").alias("_named"))
    return out.drop("_path").join(named, "app_id", "left").withColumn("app_id", F.coalesce("_named", "app_id")).drop("_named")


def _app_of(path: str) -> str:
    m = re.search(_ROLLED, path) or re.search(_SINGLE, path)
    return m.group(1)


def _m(path: str) -> Column:
    return F.col(f"`Task Metrics`.{path}")


def tasks(events: DataFrame) -> DataFrame:
    """One row per finished task attempt (``SparkListenerTaskEnd``)."""
    te = events.where(F.col("Event") == "SparkListenerTaskEnd")
    ti = "`Task Info`"
    return te.select(
        "app_id",
        F.col("`Stage ID`").alias("stage_id"),
        F.col("`Stage Attempt ID`").alias("stage_attempt"),
        F.col(f"{ti}.`Task ID`").alias("task_id"),
        F.col(f"{ti}.Index").alias("task_index"),
        F.col(f"{ti}.Attempt").alias("attempt"),
        F.col(f"{ti}.`Executor ID`").alias("executor_id"),
        F.col(f"{ti}.Host").alias("host"),
        F.col(f"{ti}.`Launch Time`").alias("launch_time"),
        F.col(f"{ti}.`Finish Time`").alias("finish_time"),
        (F.col(f"{ti}.`Finish Time`") - F.col(f"{ti}.`Launch Time`")).alias("duration_ms"),
        F.coalesce(F.col(f"{ti}.Failed"), F.lit(False)).alias("failed"),
        F.coalesce(F.col(f"{ti}.Killed"), F.lit(False)).alias("killed"),
        F.col("`Task End Reason`.Reason").alias("end_reason"),
        F.coalesce(F.col("`Task End Reason`.Description"), F.col("`Task End Reason`.`Loss Reason`"))
        .alias("failure_detail"),
        _m("`Executor Run Time`").alias("run_time_ms"),
        _m("`JVM GC Time`").alias("gc_time_ms"),
        _m("`Peak Execution Memory`").alias("peak_execution_memory"),
        _m("`Memory Bytes Spilled`").alias("memory_spilled"),
        _m("`Disk Bytes Spilled`").alias("disk_spilled"),
        _m("`Input Metrics`.`Bytes Read`").alias("input_bytes"),
        _m("`Input Metrics`.`Records Read`").alias("input_records"),
        _m("`Output Metrics`.`Bytes Written`").alias("output_bytes"),
        _m("`Output Metrics`.`Records Written`").alias("output_records"),
        (F.coalesce(_m("`Shuffle Read Metrics`.`Remote Bytes Read`"), F.lit(0))
         + F.coalesce(_m("`Shuffle Read Metrics`.`Local Bytes Read`"), F.lit(0))).alias("shuffle_read_bytes"),
        _m("`Shuffle Read Metrics`.`Total Records Read`").alias("shuffle_read_records"),
        _m("`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_write_bytes"),
        _m("`Shuffle Write Metrics`.`Shuffle Records Written`").alias("shuffle_write_records"),
    )


def stages(events: DataFrame) -> DataFrame:
    """One row per completed stage attempt (``SparkListenerStageCompleted``)."""
    si = "`Stage Info`"
    return events.where(F.col("Event") == "SparkListenerStageCompleted").select(
        "app_id",
        F.col(f"{si}.`Stage ID`").alias("stage_id"),
        F.col(f"{si}.`Stage Attempt ID`").alias("stage_attempt"),
        F.col(f"{si}.`Stage Name`").alias("stage_name"),
        F.col(f"{si}.`Number of Tasks`").alias("num_tasks"),
        F.col(f"{si}.`Submission Time`").alias("submission_time"),
        F.col(f"{si}.`Completion Time`").alias("completion_time"),
        (F.col(f"{si}.`Completion Time`") - F.col(f"{si}.`Submission Time`")).alias("duration_ms"),
        F.col(f"{si}.`Failure Reason`").alias("failure_reason"),
    )


def jobs(events: DataFrame) -> DataFrame:
    """Job start rows exploded to one row per (job, stage), with the job description.

    The description (``setJobDescription``) tells apart several queries run in
    one application.
    """
    return events.where(F.col("Event") == "SparkListenerJobStart").select(
        "app_id",
        F.col("`Job ID`").alias("job_id"),
        F.col("`Submission Time`").alias("submission_time"),
        F.col("Properties").getItem("spark.job.description").alias("description"),
        F.explode_outer("`Stage IDs`").alias("stage_id"),
    )


def executors(events: DataFrame) -> DataFrame:
    """Executor added / removed events."""
    return events.where(F.col("Event").isin("SparkListenerExecutorAdded", "SparkListenerExecutorRemoved")).select(
        "app_id",
        F.col("`Executor ID`").alias("executor_id"),
        F.when(F.col("Event") == "SparkListenerExecutorAdded", "added").otherwise("removed").alias("change"),
        F.col("Timestamp").alias("time"),
        F.col("`Executor Info`.Host").alias("host"),
        F.col("`Executor Info`.`Total Cores`").alias("cores"),
        F.col("`Removed Reason`").alias("reason"),
    )


def applications(events: DataFrame) -> DataFrame:
    """Per application: name, user, start, end (NULL while running), duration."""
    ev = events.where(F.col("Event").isin("SparkListenerApplicationStart", "SparkListenerApplicationEnd"))
    is_start = F.col("Event") == "SparkListenerApplicationStart"
    out = ev.groupBy("app_id").agg(
        F.max(F.when(is_start, F.col("`App Name`"))).alias("app_name"),
        F.max(F.when(is_start, F.col("User"))).alias("user"),
        F.min(F.when(is_start, F.col("Timestamp"))).alias("start_time"),
        F.max(F.when(~is_start, F.col("Timestamp"))).alias("end_time"),
    )
    return out.withColumn("duration_ms", F.col("end_time") - F.col("start_time"))


def event_tables(events: DataFrame) -> dict[str, DataFrame]:
    """The five tables from one events DataFrame (raw or ingested)."""
    return {"tasks": tasks(events), "stages": stages(events), "jobs": jobs(events),
            "executors": executors(events), "applications": applications(events)}


def read_event_tables(spark: SparkSession, path: str | list[str]) -> dict[str, DataFrame]:
    """The five tables straight from the logs."""
    return event_tables(read_events(spark, path))


def ingest_events(spark: SparkSession, path: str | list[str], out_path: str) -> DataFrame:
    """Parse the logs once and keep the typed events as a Parquet table.

    One pass over the JSON; later diagnostics read the columnar table, where
    Spark prunes nested columns to the fields each query uses.
    """
    read_events(spark, path).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)
