"""Structured Streaming runners for the two queries.

Plan of one running result (e.g. Q1, 7 days)::

    source -> validity -> withWatermark(create_ts, delay)
           -> count per (1h, article)            [state store, append]
           -> sum per (24h, article) over window_time(1h window)
           -> sum per (7d,  article)
           -> foreachBatch: top-3 per window -> sink (text / parquet / kafka)

* The watermark is global, so all keys of a window leave the append-mode
  state in the same micro-batch; ranking inside ``foreachBatch`` is exact
  and reuses the batch operator (``top_n``) unchanged — no unbounded
  per-window buffer is kept in state.
* Each batch that closes a window writes to ``<path>/batch=<id>`` with
  overwrite, so a batch replayed after a failure replaces its own output
  (idempotent); other batches write nothing.  Text lines of a batch are
  sorted by window start.  A topic gets a replayed line again, under the same
  key (result and window): readers keep one per key.
* ``checkpointLocation`` is mandatory: offsets, state and commits survive
  driver or executor loss.
* Late data: a record behind the watermark of the previous batch is
  dropped by the state operator and counted in ``numRowsDroppedByWatermark``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windtally.functions.render import profile_line, ranking_line, with_latency
from windtally.functions.timewin import DAY, DAYS30, HOUR, WEEK
from windtally.operators.ranking import ordered_profile, ranking_array, top_n, with_window_max
from windtally.operators.rollup import flatten, hierarchy, rollup
from windtally.plans.queries import bucket_counts_all
from windtally.sources.sinks import result_records, write_kafka

Q1_CHAIN = {"1h": (HOUR,), "24h": (HOUR, DAY), "7d": (HOUR, DAY, WEEK)}
Q2_SPEC = {"24h": DAY, "7d": WEEK, "30d": DAYS30}


def watermarked(comments: DataFrame, delay: str = "0 seconds", time_col: str = "create_ts") -> DataFrame:
    """Event time = ``create_ts``; ``delay`` = allowed out-of-orderness."""
    return comments.withWatermark(time_col, delay)


def window_counts(comments: DataFrame, query: str, window: str, latency: bool = False,
                  delay: str = "0 seconds", chained: bool = True, distinct: bool = False) -> DataFrame:
    """The stateful (append-mode) part of a result: keyed counts per window.

    ``distinct`` counts a comment once however often its message is sent: its
    id is kept until the watermark passes the comment, and a message that comes
    after that is late itself.

    ``chained`` (default, as specified) builds Q1's larger windows from the
    closed smaller ones (1h -> 24h -> 7d: one state store per level).  With
    ``chained=False`` the result window is counted directly from the
    comments — one shuffle and one state store; equal on in-order data, but a
    record that is late for its hour yet inside an open day/week is then
    still counted."""
    wm = watermarked(comments, delay)
    if distinct:
        wm = wm.dropDuplicatesWithinWatermark(["comment_id"])
    if query == "q1":
        cols = ["article_id", "create_ts"] + (["entry_time"] if latency else [])
        chain = Q1_CHAIN[window] if chained else Q1_CHAIN[window][-1:]
        return hierarchy(wm.select(*cols), chain, ["article_id"], with_entry=latency)[chain[-1].name]
    if query == "q2":
        return rollup(bucket_counts_all(wm, latency), Q2_SPEC[window], ["bucket"])
    raise ValueError(f"unknown query {query!r}")


def finish_batch(agg: DataFrame, query: str, fmt: str, latency: bool = False) -> DataFrame:
    """Turn closed-window counts into the result rows (``rows``) or lines."""
    flat = flatten(agg)
    if query == "q1":
        ranked = top_n(flat)
        if fmt == "rows":
            return with_latency(ranked) if latency else ranked
        lines = ranking_line(ranking_array(ranked))
    else:
        if fmt == "rows":
            # window-wide max ingest time on every bucket row (<= 12 rows per window)
            return with_latency(with_window_max(flat)) if "max_entry_time" in flat.columns else flat
        lines = profile_line(ordered_profile(flat))
    return with_latency(lines) if latency else lines


def batch_writer(path: str, query: str, fmt: str = "rows", latency: bool = False,
                 sink: str = "parquet", kafka_options: dict[str, str] | None = None
                 ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: finish the closed windows and write them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Q1 with latency reads the closed windows twice (ranking + window
        # totals): keep them instead of re-running the stateful part.
        twice = latency and query == "q1"
        batch = batch.persist() if twice else batch
        # the result is bounded: 3 or 12 rows for each closed window
        out = finish_batch(batch, query, fmt, latency).persist()
        try:
            if out.count():  # a batch that closes no window leaves no folder
                _write(out, batch_id)
        finally:
            out.unpersist()
            if twice:
                batch.unpersist()

    def _write(out: DataFrame, batch_id: int) -> None:
        if sink == "parquet":
            out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        elif sink == "text":
            ordered = out.orderBy("window_start") if "window_start" in out.columns else out
            ordered.select("value").write.mode("overwrite").text(f"{path}/batch={batch_id}")
        elif sink == "kafka":
            write_kafka(result_records(out, (kafka_options or {}).get("topic", query)), kafka_options or {})
        else:
            raise ValueError(f"unknown sink {sink!r}")

    return write


def _start_with_partitions(writer, spark, state_partitions: int | None) -> StreamingQuery:
    """Start ``writer``; with ``state_partitions`` the shuffle/state partition
    count is set only while the query starts (the stream keeps its own copy
    of the session conf, and the count is then fixed by the checkpoint)."""
    if not state_partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(state_partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def start(comments: DataFrame, query: str, window: str, *, path: str, checkpoint: str,
          fmt: str = "rows", latency: bool = False, delay: str = "0 seconds",
          sink: str = "parquet", kafka_options: dict[str, str] | None = None,
          trigger: dict | None = None, name: str | None = None,
          state_partitions: int | None = None, chained: bool = True, distinct: bool = False) -> StreamingQuery:
    """Start one continuous result (one of the six) and return its handle.

    ``state_partitions``: number of state-store partitions per stateful
    operator (default: the session's shuffle partitions); size it to the
    cluster's cores, it cannot change for an existing checkpoint."""
    counts = window_counts(comments, query, window, latency, delay, chained, distinct)
    w = (counts.writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(batch_writer(path, query, fmt, latency, sink, kafka_options)))
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return _start_with_partitions(w, comments.sparkSession, state_partitions)


def profile_lines_stream(comments: DataFrame, window: str, delay: str = "0 seconds") -> DataFrame:
    """Q2 entirely in append-mode state: 2 h counts -> ``window`` sums ->
    one ordered profile line per closed window.

    Unlike the top-3 ranking, the profile is bounded (at most 12 buckets per
    window), so the per-window list may live in state and the result can go
    to any native streaming sink (text, Kafka) without ``foreachBatch``."""
    from pyspark.sql import functions as F

    from windtally.functions.render import ARROW, PROFILE_ITEM, window_label

    per_bucket = window_counts(comments, "q2", window, delay=delay)
    spec = Q2_SPEC[window]
    per_window = per_bucket.groupBy(spec.over_window("window").alias("window")).agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("profile"))
    items = F.array_join(F.transform("profile", lambda x: F.concat(
        F.lit(PROFILE_ITEM[0]), x["bucket"], F.lit(PROFILE_ITEM[1]), x["n"].cast("string"),
        F.lit(PROFILE_ITEM[2]))), "")
    start_ntz = F.col("window.start").cast("timestamp_ntz")
    return per_window.select(start_ntz.alias("window_start"),
                             F.concat(window_label(start_ntz), F.lit(ARROW), items).alias("value"))


def start_native(lines: DataFrame, *, checkpoint: str, sink: str = "text", path: str | None = None,
                 kafka_options: dict[str, str] | None = None, trigger: dict | None = None,
                 state_partitions: int | None = None) -> StreamingQuery:
    """Append-mode stream straight to a file or Kafka sink (no foreachBatch)."""
    if sink == "kafka":
        lines = result_records(lines, (kafka_options or {}).get("topic", "result"))
    w = lines.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if sink == "kafka":
        w = w.format("kafka").options(**(kafka_options or {}))
    else:
        w = w.format(sink).option("path", path)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return _start_with_partitions(w, lines.sparkSession, state_partitions)


# ------------------------------------------------------------------ staging
def stage_rows(checked: DataFrame) -> DataFrame:
    """Validated rows for the stage: typed members, verdict, and the raw
    message only for rejects (the quarantine)."""
    from pyspark.sql import functions as F

    from windtally.schema import TYPED_COLUMNS

    bad = ~F.col("is_valid")
    return checked.select(*TYPED_COLUMNS, "is_valid", "reject_reason",
                          F.when(bad, F.col("key")).alias("raw_key"),
                          F.when(bad, F.col("value")).alias("raw_value"))


def start_staging(checked: DataFrame, *, stage: str, checkpoint: str,
                  trigger: dict | None = None) -> StreamingQuery:
    """Decode + validate the source stream **once** into a Parquet stage.

    The file sink commits through its metadata log, so the stage is
    exactly-once even when a batch is retried; every result stream then reads
    the stage (columnar, pruned to the columns it needs) instead of
    re-reading and re-parsing the topic once per result."""
    w = (stage_rows(checked).writeStream.format("parquet").outputMode("append")
         .option("path", stage).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def staged_comments(spark, stage: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Valid typed comments from the stage, as a stream."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from windtally.schema import COMMENT_SCHEMA, TYPED_COLUMNS

    schema = T.StructType(COMMENT_SCHEMA.fields + [
        T.StructField("is_valid", T.BooleanType()), T.StructField("reject_reason", T.StringType()),
        T.StructField("raw_key", T.StringType()), T.StructField("raw_value", T.StringType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(stage).filter(F.col("is_valid")).select(*TYPED_COLUMNS)


def dropped_late_rows(handle: StreamingQuery) -> int:
    """Records discarded as late (behind the watermark) over the query's
    recent progress — the T4 late-data metric."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in handle.recentProgress for op in p.get("stateOperators", []))


def staged_rejects(spark, stage: str) -> DataFrame:
    """The quarantine held in the stage (batch read): raw key/value + reason."""
    return spark.read.parquet(stage).filter("NOT is_valid").selectExpr(
        "raw_key AS key", "raw_value AS value", "reject_reason")
