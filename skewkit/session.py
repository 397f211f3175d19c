"""Session-level helpers: scratch locations and the local test session.

Library code never builds a session and never changes session-wide
settings; it only reads them. ``local_session`` is for tests and the bench.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a context handle (Spark Connect)
        return None


def _is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else (spark.conf.get("spark.master", "") or "")
    return master.startswith("local")


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else (spark.conf.get("spark.app.id", "") or "")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (the context's checkpoint dir or
    ``spark.checkpoint.dir``). Only a local-mode session without one gets a
    fresh temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf and sc is not None:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
    if conf and sc is None:
        return conf
    if not conf:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS/GCS)")
        conf = tempfile.mkdtemp(prefix="skewkit-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", conf)
            return conf
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/skewkit/{name}-{uuid.uuid4().hex[:12]}"


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30,
          "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def parse_bytes(text: str) -> int:
    """Spark's byte-size strings ("64MB", "256m", "1g", "67108864") as bytes."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def conf_bytes(spark: SparkSession, key: str, default: str) -> int:
    """A byte-size setting of the session (read only)."""
    return parse_bytes(spark.conf.get(key, default) or default)


def advisory_partition_bytes(spark: SparkSession) -> int:
    """The size AQE aims for per shuffle partition."""
    return conf_bytes(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes ``df`` once (an eager
    reliable checkpoint of an unpersisted Dataset computes it twice) and
    stores it columnar; survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    table.scratch_path = path
    return table


def discard(*tables) -> None:
    """Delete tables that ``materialize`` wrote, once nothing unwritten reads them any more."""
    for table in tables:
        path = table.__dict__.pop("scratch_path", None)
        sc = _context(table.sparkSession)
        if path and sc is not None:
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def master_of(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.master if sc is not None else (spark.conf.get("spark.master", "local[*]") or "local[*]")


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "skewkit",
                  extra: dict[str, str] | None = None, master: str | None = None) -> SparkSession:
    """A session with AQE on and the UI off: ``local[cpus]`` (tests, bench) or ``master``."""
    b = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
