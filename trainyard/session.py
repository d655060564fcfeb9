"""Session construction and the shared work folder.

Everything that must survive an executor loss (loop checkpoints, tables
handed from one job to the next) is written below ``spark.checkpoint.dir``,
which on a cluster names a shared file system.  The setting is read from the
session; where it is unset, a folder below ``spark.sql.warehouse.dir`` serves.
On a cluster with neither on shared storage the jobs stop.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that make a session behave the way the operators expect.
# Session time zone is pinned to UTC: all times are zone-less wall-clock
# values (timestamp_ntz) and must not shift.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcasts happen only through this size check (planner + AQE).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Many small XML files per snapshot: charge each file like 1 MB so the
    # scan packs several files into one task.
    "spark.sql.files.openCostInBytes": str(1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Listing many partition folders: a few listing tasks, not one per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# Runtime SQL settings the jobs rely on; applied to sessions created
# elsewhere (e.g. by a driver) through apply_runtime_conf.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


# Remove a query's shuffle files when it ends, not when the driver happens to
# collect its garbage.  Set for single writes: none of them is executed twice.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A runtime setting for one write, then the session's previous value."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def apply_runtime_conf(spark: SparkSession) -> None:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def get_session(master: str | None = None, app: str = "trainyard",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder: the cluster's ``spark.checkpoint.dir``
    as it is, or, where that is unset, one below the SQL warehouse (shared
    storage on a cluster, the working folder's warehouse in tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not sc.master.startswith("local") and (
                warehouse.startswith("file:") or warehouse.startswith("/")):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that driver and "
                "executors share")
        configured = warehouse + "/_checkpoint"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder (a full URI where the setting is one) under the shared
    checkpoint location for one table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/trainyard/{name}-{uuid.uuid4().hex[:12]}"
