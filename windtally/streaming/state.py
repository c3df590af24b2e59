"""Windows that are still open: read, reported and carried into another checkpoint.

``open_counts`` reads the state store of the shared levels with Spark's
``statestore`` source: with the closed rows of the logs it accounts for every
comment a level has taken in.

``seed_generation`` lets a stopped query go on with another number of state
partitions, which Spark fixes for the life of a checkpoint.  The open windows
of each level are written as partial counts to a seed folder (same columns as
a log, one heartbeat with the old watermark), and a new generation of levels, with new
checkpoints and logs, reads its own seeds beside its source.  Nothing is
counted twice: the seeds of a level stand for all that its old state held, and the
source must deliver only what came after the old checkpoint.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windtally.operators.rollup import ENTRY
from windtally.session import ensure_dir, rename_path
from windtally.streaming import shared


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch a checkpoint has committed; -1 if none."""
    ensure_dir(spark, f"{checkpoint}/commits")
    done = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoint}/commits").select(
        F.regexp_extract("path", r"/(\d+)$", 1).cast("long").alias("id"))
    return done.agg(F.coalesce(F.max("id"), F.lit(-1))).first()[0]


def source_offsets(spark: SparkSession, checkpoint: str) -> list[str]:
    """End offsets of the sources after the last batch, as in the offset log (for a
    topic: the text that the reader takes as ``startingOffsets``)."""
    lines = [r[0] for r in spark.read.text(f"{checkpoint}/offsets/{last_batch(spark, checkpoint)}").collect()]
    return [x for x in lines if x.startswith("{") and "batchWatermarkMs" not in x]


def state_rows(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """Open windows of one level: ``t`` (start), ``key``, ``n``, ``max_entry_time``."""
    state = spark.read.format("statestore").load(checkpoint)
    value, keys = state.schema["value"].dataType.fieldNames(), state.schema["key"].dataType.fieldNames()
    count = next(f for f in value if f.startswith(("count", "sum")))
    entry = F.col("value.max") if "max" in value else F.lit(None).cast("long")
    name = F.col(f"key.{key}") if key in keys else F.lit(None).cast("string")
    return (state.select(F.col("key.window.start").alias("t"), name.cast("string").alias("key"), F.col(f"value.{count}").cast("long").alias("n"), entry.alias(ENTRY))
            .where("n > 0"))


def open_counts(spark: SparkSession, query: str, window: str, checkpoint: str) -> DataFrame:
    """``window_start, key, n, max_entry_time`` of the ``window`` windows that are
    open: what the level's own state holds and what is still in the levels that feed it.

    Exact while the levels rest; while they run, rows on their way from one
    level to the next are in neither state."""
    level, parts = shared.LEVELS[query][window], []
    spec, name = level.spec, window
    while name is not None:
        parts.append(state_rows(spark, f"{checkpoint}/{name}", shared.KEY[query]))
        name = shared.LEVELS[query][name].source
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    if query == "q2":  # the two-hour level has no key in its state
        from windtally.functions.timewin import bucket_label
        every = every.withColumn("key", F.coalesce("key", bucket_label("t")))
    return (every.groupBy(spec.over("t")["start"].cast("timestamp_ntz").alias("window_start"), F.col("key").alias(shared.KEY[query]))
            .agg(F.sum("n").alias("n"), F.max(ENTRY).alias(ENTRY)))


def closed_counts(spark: SparkSession, query: str, window: str, logs: str) -> DataFrame:
    """``window_start, key, n, max_entry_time`` of all committed windows of a level."""
    return (spark.read.schema(shared.LOG_SCHEMA).parquet(f"{logs}/{window}").where("NOT beat")
            .select(F.col("t").cast("timestamp_ntz").alias("window_start"), F.col("key").alias(shared.KEY[query]), "n", ENTRY))


def seed_generation(spark: SparkSession, query: str, *, checkpoint: str, seeds: str, wanted: tuple[str, ...] | None = None) -> dict[str, str]:
    """Write each level's open windows to ``seeds/<level>``; returns these folders by level.

    The old queries must be stopped.  Writing is idempotent: an existing seed folder stays."""
    out = {}
    for name in shared.chain(query, wanted):
        old, path = f"{checkpoint}/{name}", f"{seeds}/{name}"
        out[name] = path
        if shared.path_exists(spark, f"{path}/batch=0"):
            continue
        mark = shared.batch_watermark(spark, old, last_batch(spark, old))
        rows = state_rows(spark, old, shared.KEY[query]).withColumn("beat", F.lit(False))
        beat = spark.range(1).select(F.timestamp_millis(F.lit(mark)).alias("t"), F.lit(None).cast("string").alias("key"),
                                     F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias(ENTRY), F.lit(True).alias("beat"))
        ensure_dir(spark, path)
        staging = f"{path}/_staging-{uuid.uuid4().hex}"
        rows.unionByName(beat).write.parquet(staging)
        rename_path(spark, staging, f"{path}/batch=0")
    return out


def state_partitions(spark: SparkSession, checkpoint: str) -> int:
    """Number of state partitions that a checkpoint is fixed to."""
    for r in spark.read.text(f"{checkpoint}/offsets/0").collect():
        if "batchWatermarkMs" in r[0]:
            return int(json.loads(r[0])["conf"]["spark.sql.shuffle.partitions"])
    raise RuntimeError(f"no offset log in {checkpoint}")
