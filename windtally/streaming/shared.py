"""Closed windows as shared, committed logs (X3, W6): the topic is read once and
every window level keeps its state once, whatever number of results read it.

::

    comments -> 1h counts -> log 1h -> 24h sums -> log 24h -> 7d sums      (Q1)
    comments -> 2h counts -> log 2h -> 24h, 7d and 30d sums, one query each (Q2)

Each level is one streaming query with one stateful operator.  When windows
close, the level publishes its result (ranking or profile) and commits the closed
rows to its log, a folder ``batch=<id>`` that appears by one rename:

``t``               start of the window (rows) or the watermark (heartbeats)
``key``             article or time-of-day bucket; null in heartbeats
``n``               comments; 0 in heartbeats
``max_entry_time``  latest ingest time, if latency is tracked
``beat``            true for the heartbeat that every advance of the watermark writes

The next level reads the log as a file stream with ``t`` as event time.  A row's
window ended after the watermark of all earlier commits (else it had been committed
earlier), so no row is late there, and the heartbeat moves the watermark on
exactly as far as the level below had it, also while no window closes or the last
hours of a day are empty.  Heartbeats count nothing: groups of ``n = 0`` are not closed rows.

A replayed batch publishes again (idempotent) and, if its folder is there, commits
nothing.  The watermark of a batch comes from the checkpoint's own offset log,
which is written before the batch runs, so a replay sees the same value.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from windtally.functions.timewin import DAY, DAYS30, HOUR, TWO_HOURS, WEEK, WindowSpec, bucket_label
from windtally.operators.rollup import ENTRY, count_by
from windtally.plans.queries import bucket_counts_all
from windtally.session import ensure_dir, ensure_utc, path_exists, rename_path
from windtally.streaming.runner import _start_with_partitions, batch_writer, watermarked

LOG_SCHEMA = T.StructType([
    T.StructField("t", T.TimestampType()), T.StructField("key", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField(ENTRY, T.LongType()), T.StructField("beat", T.BooleanType())])


@dataclass(frozen=True)
class Level:
    """``spec`` windows, counted from the comments or summed up from the log of level ``source``."""

    spec: WindowSpec
    source: str | None = None
    published: bool = True


LEVELS = {
    "q1": {"1h": Level(HOUR), "24h": Level(DAY, "1h"), "7d": Level(WEEK, "24h")},
    "q2": {"2h": Level(TWO_HOURS, published=False), "24h": Level(DAY, "2h"), "7d": Level(WEEK, "2h"), "30d": Level(DAYS30, "2h")},
}
KEY = {"q1": "article_id", "q2": "bucket"}


def first_counts(comments: DataFrame, query: str, latency: bool = False, delay: str = "0 seconds",
                 seeds: DataFrame | None = None) -> DataFrame:
    """Counts of the first level (append mode): ``window, <key>, n[, max_entry_time]``.

    ``seeds``: log rows with partial counts of windows that another checkpoint left open."""
    ensure_utc(comments.sparkSession)
    if seeds is None:
        seen = watermarked(comments, delay)
        return count_by(seen, HOUR, ["article_id"], with_entry=latency) if query == "q1" else bucket_counts_all(seen, latency)
    one = F.lit(1) if query == "q1" else F.when(F.col("depth") == 1, 1).otherwise(0)
    key = F.col("article_id") if query == "q1" else F.lit(None).cast("string")
    entry = F.when(one > 0, F.col("entry_time")) if latency else F.lit(None).cast("long")
    rows = comments.select(F.col("create_ts").alias("t"), key.alias("key"), one.cast("long").alias("n"), entry.alias(ENTRY))
    out = summed(rows.unionByName(seeds.select("t", key_or_null(query), "n", ENTRY)), LEVELS[query][next(iter(LEVELS[query]))].spec, KEY[query], latency, delay)
    return out if query == "q1" else out.withColumn(KEY[query], bucket_label(F.col("window.start")))


def key_or_null(query: str):
    """The first level of Q2 counts by window alone; its bucket follows from the window."""
    return F.col("key") if query == "q1" else F.lit(None).cast("string").alias("key")


def log_stream(spark: SparkSession, log: str) -> DataFrame:
    """Rows and heartbeats of a log, as a stream."""
    ensure_dir(spark, log)
    return spark.readStream.schema(LOG_SCHEMA).parquet(log)


def summed(rows: DataFrame, spec: WindowSpec, key: str, latency: bool = False, delay: str = "0 seconds") -> DataFrame:
    """Counts of a coarser level from the log rows of a finer one (append mode)."""
    aggs = [F.sum("n").alias("n")] + ([F.max(ENTRY).alias(ENTRY)] if latency else [])
    cols = ["t", F.col("key").alias(key), "n"] + ([ENTRY] if latency else [])
    # the heartbeats take part, else they would be filtered out before the watermark sees them
    return (rows.select(*cols).withWatermark("t", delay)
            .groupBy(spec.over("t").alias("window"), key).agg(*aggs).filter("n > 0"))


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Watermark (epoch ms) that a batch runs with; 0 before the first event."""
    if batch_id < 0:
        return 0
    for row in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect():
        if row[0].startswith("{") and "batchWatermarkMs" in row[0]:
            return int(json.loads(row[0])["batchWatermarkMs"])
    raise RuntimeError(f"no watermark in {checkpoint}/offsets/{batch_id}")


def committed_batches(spark: SparkSession, log: str) -> DataFrame:
    """All committed rows of a log, as a table."""
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def log_writer(log: str, checkpoint: str, key: str, publish: Callable[[DataFrame, int], None] | None = None
               ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of a level: publish the closed windows, then commit them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        final = f"{log}/batch={batch_id}"
        if path_exists(spark, final):
            return
        mark, before = (batch_watermark(spark, checkpoint, b) for b in (batch_id, batch_id - 1))
        batch = batch.persist()
        try:
            if mark <= before and batch.isEmpty():
                return
            if publish is not None:
                publish(batch, batch_id)
            entry = F.col(ENTRY) if ENTRY in batch.columns else F.lit(None).cast("long").alias(ENTRY)
            out = batch.select(F.col("window.start").alias("t"), F.col(key).cast("string").alias("key"), F.col("n").cast("long").alias("n"), entry,
                               F.lit(False).alias("beat"))
            if mark > before:
                out = out.union(spark.range(1).select(F.timestamp_millis(F.lit(mark)), F.lit(None).cast("string"), F.lit(0).cast("long"),
                                                      F.lit(None).cast("long"), F.lit(True)))
            staging = f"{log}/_staging-{batch_id}-{uuid.uuid4().hex}"
            out.write.parquet(staging)
            rename_path(spark, staging, final)
        finally:
            batch.unpersist()

    return write


def start_level(comments: DataFrame | None, spark: SparkSession, query: str, name: str, *, logs: str, out: str | Callable[[str], str], checkpoint: str,
                fmt: str = "rows", latency: bool = False, delay: str = "0 seconds", sink: str = "parquet",
                kafka_options: dict[str, str] | None = None, trigger: dict | None = None,
                state_partitions: int | None = None, seeds: str | None = None) -> StreamingQuery:
    """Start one level; ``comments`` is needed for the first one only.

    ``seeds``: folder with the windows another checkpoint left open (``state.seed_generation``);
    give it for the whole life of the new checkpoint."""
    level, key = LEVELS[query][name], KEY[query]
    seeded = log_stream(spark, seeds) if seeds else None
    if level.source is None:
        counts = first_counts(comments, query, latency, delay, seeded)
    else:
        rows = log_stream(spark, f"{logs}/{level.source}")
        counts = summed(rows.unionByName(seeded) if seeds else rows, level.spec, key, latency)
    log, own = f"{logs}/{name}", f"{checkpoint}/{name}"
    ensure_dir(spark, log)
    target = out(name) if callable(out) else f"{out}/{name}"
    publish = batch_writer(target, query, fmt, latency, sink, kafka_options) if level.published else None
    w = (counts.writeStream.outputMode("append").option("checkpointLocation", own).queryName(f"{query}_{name}_{uuid.uuid4().hex[:8]}")
         .foreachBatch(log_writer(log, own, key, publish)).trigger(**(trigger or {"availableNow": True})))
    return _start_with_partitions(w, spark, state_partitions)


def chain(query: str, wanted: tuple[str, ...] | None = None) -> list[str]:
    """Level names in the order they feed each other; with ``wanted``, those levels and what they need."""
    need = set(wanted or LEVELS[query])
    for name in reversed(list(LEVELS[query])):
        if name in need and LEVELS[query][name].source:
            need.add(LEVELS[query][name].source)
    return [n for n in LEVELS[query] if n in need]


def start_shared(comments: DataFrame, query: str, *, logs: str, out: str | Callable[[str], str], checkpoint: str, wanted: tuple[str, ...] | None = None,
                 kafka: Callable[[str], dict[str, str]] | None = None, trigger: dict | None = None,
                 seeds: dict[str, str] | None = None, **options) -> list[StreamingQuery]:
    """Start the levels of ``query``; results go to ``out/<window>`` or where the function ``out`` says.

    With ``availableNow`` (default) each level is finished before the next one
    starts; with a processing-time trigger all of them run together."""
    spark, handles = comments.sparkSession, []
    at_once = not trigger or "availableNow" in trigger or "once" in trigger
    for name in chain(query, wanted):
        h = start_level(comments, spark, query, name, logs=logs, out=out, checkpoint=checkpoint, trigger=trigger,
                        kafka_options=kafka(name) if kafka else None, seeds=(seeds or {}).get(name), **options)
        handles.append(h)
        if at_once:
            h.awaitTermination()
            if h.exception() is not None:
                raise RuntimeError(str(h.exception()))
    return handles
