import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from event_workload import recorded_log
from skewkit.operators import diagnostics as dg
from skewkit.sources import eventlog as ev

APP = "app-20240101-0001"


def _task(stage, tid, ms, records, failed=False, reason="Success", metrics=True, executor="1",
          shuffle_write=0, out_bytes=0, spill=0, gc=0):
    e = {
        "Event": "SparkListenerTaskEnd", "Stage ID": stage, "Stage Attempt ID": 0, "Task Type": "ResultTask",
        "Task End Reason": {"Reason": reason},
        "Task Info": {"Task ID": tid, "Index": tid, "Attempt": 0, "Launch Time": 1000, "Finish Time": 1000 + ms,
                      "Executor ID": executor, "Host": "h", "Failed": failed, "Killed": False},
    }
    if metrics:
        e["Task Metrics"] = {
            "Executor Run Time": ms, "JVM GC Time": gc, "Memory Bytes Spilled": spill * 2, "Disk Bytes Spilled": spill,
            "Input Metrics": {"Bytes Read": records * 10, "Records Read": records},
            "Output Metrics": {"Bytes Written": out_bytes, "Records Written": 1 if out_bytes else 0},
            "Shuffle Read Metrics": {"Remote Bytes Read": 0, "Local Bytes Read": 0, "Total Records Read": 0},
            "Shuffle Write Metrics": {"Shuffle Bytes Written": shuffle_write, "Shuffle Records Written": 1},
        }
    return e


@pytest.fixture(scope="module")
def log_dir():
    d = tempfile.mkdtemp(prefix="skewkit-evlog-")
    events = [
        {"Event": "SparkListenerLogStart", "Spark Version": "4.1.2"},
        {"Event": "SparkListenerApplicationStart", "App Name": "demo", "App ID": APP, "Timestamp": 0, "User": "u"},
        {"Event": "SparkListenerExecutorAdded", "Timestamp": 1, "Executor ID": "1",
         "Executor Info": {"Host": "h", "Total Cores": 4}},
        {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": 5, "Stage IDs": [0, 1],
         "Properties": {"spark.job.description": "skewed job"}},
    ]
    # stage 0: one task ten times slower and larger than the rest, a spill
    events += [_task(0, i, 100, 10) for i in range(7)]
    events.append(_task(0, 7, 2000, 500, spill=1 << 20, gc=1500, shuffle_write=300 << 20))
    # stage 1: a failed task and one without metrics; 5 tiny writes
    events.append(_task(1, 8, 50, 0, failed=True, reason="ExecutorLostFailure"))
    events.append(_task(1, 9, 50, 0, metrics=False))
    events += [_task(1, 10 + i, 20, 1, out_bytes=1000) for i in range(5)]
    events.append({"Event": "SparkListenerExecutorRemoved", "Timestamp": 90, "Executor ID": "1",
                   "Removed Reason": "lost"})
    events.append({"Event": "SparkListenerStageCompleted", "Stage Info": {
        "Stage ID": 0, "Stage Attempt ID": 0, "Stage Name": "s0", "Number of Tasks": 8,
        "Submission Time": 10, "Completion Time": 3000}})
    events.append({"Event": "SparkListenerApplicationEnd", "Timestamp": 5000})
    with open(os.path.join(d, APP), "w") as f:
        for e in events:
            f.write(json.dumps(e) + "\n")
    return d


def test_tables(spark, log_dir):
    t = ev.read_event_tables(spark, log_dir)
    tasks = t["tasks"]
    assert tasks.count() == 15
    assert {r["app_id"] for r in tasks.select("app_id").distinct().collect()} == {APP}
    no_metrics = tasks.where(F.col("task_id") == 9).first()
    assert no_metrics["run_time_ms"] is None and no_metrics["shuffle_read_bytes"] == 0
    app = t["applications"].first()
    assert (app["app_name"], app["duration_ms"]) == ("demo", 5000)
    assert t["stages"].first()["duration_ms"] == 2990
    assert t["executors"].count() == 2
    assert {r["description"] for r in t["jobs"].collect()} == {"skewed job"}


def test_diagnostics(spark, log_dir):
    t = ev.read_event_tables(spark, log_dir)
    skew = {r["stage_id"]: r for r in dg.task_skew(t["tasks"], t["jobs"]).collect()}
    assert skew[0]["time_ratio"] == 20.0 and skew[0]["records_ratio"] == 50.0
    assert skew[0]["description"] == "skewed job"
    mem = {r["stage_id"]: r for r in dg.memory_pressure(t["tasks"], t["executors"]).collect()}
    assert mem[0]["disk_spilled"] == 1 << 20 and mem[0]["memory_spilled"] == 2 << 20
    assert mem[1]["failed_tasks"] == 1 and mem[1]["executor_lost_tasks"] == 1
    assert mem[1]["executors_removed"] == 1
    wr = dg.write_sizes(t["tasks"], t["jobs"]).first()
    assert (wr["write_tasks"], wr["mean_bytes_per_task"]) == (5, 1000.0)
    found = {(r["stage_id"], r["finding"]) for r in dg.findings(t["tasks"], t["jobs"], t["executors"]).collect()}
    assert found == {(0, "large_shuffle"), (0, "task_skew"), (0, "disk_spill"), (0, "gc_pressure"),
                     (1, "failed_tasks"), (1, "small_files")}
    summary = dg.applications_summary(t["applications"], t["tasks"]).first()
    assert (summary["tasks"], summary["failed_tasks"], summary["stages"]) == (15, 1, 2)


def test_compare_runs(spark, log_dir):
    t = ev.read_event_tables(spark, log_dir)
    totals = dg.run_totals(t["tasks"]).union(
        dg.run_totals(t["tasks"]).withColumn("run", F.lit("other")).withColumn("tasks", F.lit(30).cast("long")))
    cmp = {r["metric"]: r for r in dg.compare_runs(totals, APP, "other").collect()}
    assert cmp["tasks"]["before"] == 15 and cmp["tasks"]["ratio"] == 2.0


def _raw_task_ends(log_dir):
    for prefix in ("file://", "file:"):
        if log_dir.startswith(prefix):
            log_dir = log_dir[len(prefix):]
            break
    n = 0
    for root, _, files in os.walk(log_dir):
        for name in files:
            if name.startswith(("events_", "local-", "app-")) and not name.endswith(".crc"):
                path = os.path.join(root, name)
                if name.endswith(".zstd"):
                    import zstandard
                    with open(path, "rb") as fh:
                        text = zstandard.ZstdDecompressor().stream_reader(fh).read().decode()
                else:
                    with open(path) as fh:
                        text = fh.read()
                n += sum(1 for line in text.splitlines() if '"Event":"SparkListenerTaskEnd"' in line
                         or '"Event": "SparkListenerTaskEnd"' in line)
    return n


def test_recorded_workload(spark):
    """The recorded run over the given tables: broadcast removes the big shuffle."""
    log = recorded_log(SF_SMALL)
    t = ev.read_event_tables(spark, log)
    assert t["tasks"].count() == _raw_task_ends(log) > 0
    totals = {r["run"]: r for r in dg.run_totals(t["tasks"], t["jobs"], by="description").collect()}
    assert totals["broadcast_join_agg"]["shuffle_write_bytes"] < totals["shuffle_join_agg"]["shuffle_write_bytes"]
    found = {(r["description"], r["finding"]) for r in dg.findings(t["tasks"], t["jobs"]).collect()}
    assert ("small_files_write", "small_files") in found
    assert ("compacted_write", "small_files") not in found
    assert {"skewed_agg", "salted_agg"} <= set(totals)


def test_stream_windows_match_batch(spark):
    from skewkit.session import scratch_path
    from skewkit.streaming.eventlog_stream import ingest_available, merged_windows

    log = recorded_log(SF_SMALL)
    batch = ev.read_event_tables(spark, log)["tasks"]
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    ingest_available(spark, log, out, ck, mode="update")
    ingest_available(spark, log, out, ck, mode="update")  # re-run: nothing new, nothing doubled
    win = merged_windows(spark, out)
    assert win.agg(F.sum("tasks")).first()[0] == batch.count()
    out2, ck2 = scratch_path(spark, "t-out2"), scratch_path(spark, "t-ck2")
    ingest_available(spark, log, out2, ck2, mode="update")
    assert merged_windows(spark, out2).agg(F.sum("tasks")).first()[0] == batch.count()
    assert win.agg(F.sum("shuffle_write_bytes")).first()[0] == batch.agg(F.sum("shuffle_write_bytes")).first()[0]


def test_zstd_multi_frame_log_reads_like_plain(spark, log_dir):
    import zstandard

    with open(os.path.join(log_dir, APP)) as fh:
        lines = fh.read().splitlines(keepends=True)
    d = tempfile.mkdtemp(prefix="skewkit-evlog-zstd-")
    rolled = os.path.join(d, f"eventlog_v2_{APP}")
    os.makedirs(rolled)
    half = len(lines) // 2
    with open(os.path.join(rolled, f"events_1_{APP}.zstd"), "wb") as fh:
        for chunk in (lines[:half], lines[half:]):  # two frames, as a log flushed twice
            fh.write(zstandard.ZstdCompressor().compress("".join(chunk).encode()))
    plain = ev.read_event_tables(spark, log_dir)["tasks"]
    packed = ev.read_event_tables(spark, d)["tasks"]
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, plain.collect()))


def test_stream_append_mode_emits_closed_windows(spark):
    from skewkit.session import scratch_path
    from skewkit.streaming.eventlog_stream import ingest_available

    log = recorded_log(SF_SMALL)
    total = ev.read_event_tables(spark, log)["tasks"].count()
    out, ck = scratch_path(spark, "t-app"), scratch_path(spark, "t-app-ck")
    ingest_available(spark, log, out, ck, mode="append", watermark="0 seconds")
    written = spark.read.parquet(out)
    # windows still open at the end of the input stay in state; none is written twice
    assert written.groupBy("app_id", "window_start").count().where("count > 1").count() == 0
    assert (written.agg(F.sum("tasks")).first()[0] or 0) <= total


def _packed(lines, name):
    import zstandard

    d = tempfile.mkdtemp(prefix="skewkit-evlog-zstd-")
    rolled = os.path.join(d, f"eventlog_v2_{APP}")
    os.makedirs(rolled)
    with open(os.path.join(rolled, name), "wb") as fh:
        fh.write(lines if isinstance(lines, bytes) else zstandard.ZstdCompressor().compress("".join(lines).encode()))
    return d


def _log_lines(log_dir):
    with open(os.path.join(log_dir, APP)) as fh:
        return fh.read().splitlines(keepends=True)


def test_compacted_log_gives_all_events(spark, log_dir):
    d = _packed(_log_lines(log_dir), f"events_1_{APP}.zstd.compact")
    assert ev.read_events(spark, d).count() == len(_log_lines(log_dir))


@pytest.mark.parametrize("name", [f"events_1_{APP}.zstd", f"events_1_{APP}.zstd.compact"])
def test_damaged_finished_log_is_an_error(spark, log_dir, name):
    import zstandard

    whole = zstandard.ZstdCompressor().compress("".join(_log_lines(log_dir)).encode())
    middle = len(whole) // 2
    broken = whole[:middle] + bytes(40) + whole[middle + 40:]
    for raw in (broken, whole[:middle]):
        with pytest.raises(Exception):
            ev.read_events(spark, _packed(raw, name)).count()


def test_killed_attempts_are_not_finished_tasks(spark):
    d = tempfile.mkdtemp(prefix="skewkit-evlog-")
    killed = _task(0, 9, 90_000, 10)
    killed["Task Info"]["Killed"] = True
    with open(os.path.join(d, APP), "w") as f:
        for e in [*(_task(0, i, 100, 10) for i in range(3)), killed, {"Event": "SparkListenerApplicationEnd", "Timestamp": 1}]:
            f.write(json.dumps(e) + "\n")
    row = dg.stage_summary(ev.read_event_tables(spark, d)["tasks"]).first()
    assert row["ok_tasks"] == 3 and row["max_duration_ms"] == 100
