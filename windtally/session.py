"""Spark session helpers.

The engine keeps every clock computation in UTC: hour-of-day buckets and
window labels are read in the session time zone, so it is pinned to UTC.
"""

from __future__ import annotations

import os
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_UTC = "UTC"


def get_spark(master: str | None = None, app: str = "windtally",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session configured for this engine.

    ``shuffle_partitions`` is the upper bound AQE starts from; on a cluster
    size it to roughly ``input_bytes / 128 MiB`` and let AQE coalesce.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": _UTC,
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Streaming state: keep many (window, article) keys off-heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # commit only each batch's state changes; snapshots are made in the background
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # one shared, capped memory budget for all RocksDB instances of an executor
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (idempotent runtime setting)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != _UTC:
        spark.conf.set("spark.sql.session.timeZone", _UTC)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM on one machine (``local-cluster`` has executors of its own)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster).  Where it is
    unset, a local master gets a private folder, recorded in the session so
    later calls agree; on a cluster that is an error, as executors do not see
    the driver's disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set: give a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="windtally-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/{kind}-{uuid.uuid4().hex}"
    if path.startswith("/") and _is_local(spark):  # plain local path (tests); URIs are created by Spark's writers
        os.makedirs(path, exist_ok=True)
    return path


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over the task slots, but only when its input has
    fewer partitions than there are slots.

    For CPU-heavy per-row stages (JSON/CSV decoding) fed by a source with few
    splits (one Parquet row group, a 3-partition topic).  On large inputs the
    scan already yields far more splits than slots and nothing is added.
    """
    if df.isStreaming:  # a stream's splits are per micro-batch; use source options
        return df
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < n:
        return df.repartition(n)
    return df


def ensure_dir(spark: SparkSession, path: str) -> str:
    """Create ``path`` (any Hadoop-supported URI) if missing — a driver-side
    metadata call, e.g. so a file stream can start before its first file."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (any Hadoop-supported URI) is there — a driver-side metadata call."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder; an existing ``new`` is an error."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    a, b = path(old), path(new)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(b) or not fs.rename(a, b):
        raise RuntimeError(f"cannot rename {old} to {new}")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint root and read back: the lineage ends here."""
    path = f"{scratch_path(df.sparkSession, kind)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def expired_scratch(spark: SparkSession, hours: float, root: str | None = None) -> list[str]:
    """Scratch and stage folders under the checkpoint root that nothing has touched for ``hours``.

    Returned DataFrames read their scratch tables, so nothing is removed here:
    give the list to the storage's own clean-up once the jobs that made the
    folders are over.  Checkpoints of running streams are in folders of their own choice and not listed."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root or checkpoint_root(spark))
    limit = (time.time() - hours * 3600) * 1000
    there = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(base)
    return sorted(f.getPath().toString() for f in there
                  if f.isDirectory() and f.getModificationTime() <= limit and re.search(r"-[0-9a-f]{32}$", f.getPath().getName()))
