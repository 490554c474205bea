"""Spark session settings the operators rely on.

Timestamps are zone-less (UTC session zone), ANSI mode stays on (every ratio goes
through ``try_divide``), AQE re-plans joins and coalesces/splits shuffle partitions at
run time. On a cluster the session is created by the platform: call
:func:`configure` on it, which only fills in settings that are unset.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Date-hour and daily aggregates are tiny; let AQE turn their joins into
    # broadcast joins from measured (not estimated) sizes below this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session defaults that are not already set."""
    conf = spark.conf
    for key, value in SESSION_DEFAULTS.items():
        if key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
            conf.set(key, value)  # semantics, not tuning: always pinned
        elif conf.get(key, None) in (None, ""):
            conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is unset, as
    in local tests, a fresh local folder is created and registered. Works for classic
    sessions and, through the session conf alone, for Spark Connect sessions.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side SparkContext
        sc = None
    registered = sc.getCheckpointDir() if sc is not None else None
    current = current or registered
    if not current:
        master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                "(checkpoints in a machine-local folder do not survive a lost executor)")
        current = tempfile.mkdtemp(prefix="careflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc is not None and not registered:  # once: every call would add a folder of its own
        sc.setCheckpointDir(current)
    return current


_KEPT: list[tuple[SparkSession, str]] = []


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder: like a reliable checkpoint, but its
    readers scan the columns that they need. Removed when the driver process ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/careflow-kept/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _KEPT.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _clean() -> None:
    for spark, path in _KEPT:
        try:
            if spark.sparkContext._jsc is not None:
                target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended: the shared folder's owner clears it
            return


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "careflow", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no server)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="careflow-wh-"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark
