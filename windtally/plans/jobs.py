"""Whole query jobs (J1, J2): every window size of a query in one run.

Batch: the first-level aggregate (1 h counts per article, or 2 h counts of
direct comments) is computed once, **checkpointed** to the shared
``spark.checkpoint.dir`` (lineage cut: a lost executor re-reads it instead of
re-scanning the input), and every larger window is rolled up from it.

Stream: one append-mode streaming query per result, each with its own
checkpoint folder, all started together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from windtally.functions.render import profile_line, ranking_line, with_latency
from windtally.functions.timewin import DAY, DAYS30, WEEK
from windtally.operators.quality import rejects, valid_only
from windtally.operators.ranking import ordered_profile, ranking_array, top_n, with_window_max
from windtally.operators.rollup import flatten, rollup
from windtally.plans import queries as Q
from windtally.session import checkpoint_root, ensure_dir, scratch_path
from windtally.sources.comments import encode_wire
from windtally.sources.sinks import RESULT_TOPICS, result_records, write_kafka, write_parquet, write_text
from windtally.streaming import runner, shared

WINDOWS = {"q1": ("1h", "24h", "7d"), "q2": ("24h", "7d", "30d")}


def batch_results(spark: SparkSession, comments: DataFrame, query: str, latency: bool = False,
                  fmt: str = "lines") -> dict[str, DataFrame]:
    """All window sizes of ``query`` from one checkpointed first-level aggregate."""
    checkpoint_root(spark)
    if query == "q1":
        hourly = Q.article_counts(comments, latency)["1h"].checkpoint(eager=True)
        day = rollup(hourly, DAY, ["article_id"])
        # latency: ranked levels carry per-window totals from the same aggregate
        levels = {"1h": hourly,
                  "24h": rollup(hourly, DAY, ["article_id"], window_totals=latency),
                  "7d": rollup(day, WEEK, ["article_id"], window_totals=latency)}
        ranked = {w: top_n(flatten(a)) for w, a in levels.items()}
        if fmt == "rows":
            return ranked
        return {w: ranking_line(ranking_array(r)) for w, r in ranked.items()}
    if query == "q2":
        two_h = Q.bucket_counts(comments, latency).checkpoint(eager=True)
        flat = {s.name: flatten(rollup(two_h, s, ["bucket"])) for s in (DAY, WEEK, DAYS30)}
        if latency:  # window-wide max ingest time on every bucket row
            flat = {w: with_window_max(f) for w, f in flat.items()}
        if fmt == "rows":
            return flat
        return {w: profile_line(ordered_profile(f)) for w, f in flat.items()}
    raise ValueError(f"unknown query {query!r}")


def write_batch(results: dict[str, DataFrame], query: str, sink: str, out: str | None = None,
                kafka: dict[str, str] | None = None, latency: bool = False) -> None:
    for w, df in results.items():
        topic = RESULT_TOPICS[(query, w)]
        if latency and "max_entry_time" in df.columns:
            df = with_latency(df)  # lines get the latency text, rows the column
        if sink == "text":
            write_text(df, f"{out}/{topic}")
        elif sink == "parquet":
            write_parquet(df, f"{out}/{topic}")
        elif sink == "kafka":
            write_kafka(result_records(df, topic), {**(kafka or {}), "topic": topic})
        else:
            raise ValueError(f"unknown sink {sink!r}")


def start_streams(comments: DataFrame, query: str, *, out: str, checkpoint: str, sink: str = "text",
                  latency: bool = False, delay: str = "0 seconds", trigger: dict | None = None,
                  kafka: dict[str, str] | None = None, chained: bool = True,
                  state_partitions: int | None = None) -> list[StreamingQuery]:
    """Start the three continuous results of ``query`` on one comment stream.

    ``state_partitions`` is fixed for the life of ``checkpoint``; unset, it is
    the session's ``spark.sql.shuffle.partitions``."""
    handles = []
    for w in WINDOWS[query]:
        topic = RESULT_TOPICS[(query, w)]
        handles.append(runner.start(
            comments, query, w, path=f"{out}/{topic}", checkpoint=f"{checkpoint}/{topic}",
            fmt="rows" if sink == "parquet" else "lines", latency=latency, delay=delay, sink=sink,
            kafka_options={**(kafka or {}), "topic": topic} if sink == "kafka" else None,
            trigger=trigger, name=topic.replace("-", "_"), chained=chained,
            state_partitions=state_partitions))
    return handles


def start_shared_streams(comments: DataFrame, query: str, *, logs: str, out: str, checkpoint: str, sink: str = "text",
                         latency: bool = False, delay: str = "0 seconds", trigger: dict | None = None,
                         kafka: dict[str, str] | None = None, state_partitions: int | None = None) -> list[StreamingQuery]:
    """The three continuous results of ``query`` from one read of the comments:
    each window level is one query and hands its closed windows on through
    ``logs`` (see ``streaming.shared``)."""
    topic = lambda name: RESULT_TOPICS.get((query, name), name)
    return shared.start_shared(
        comments, query, logs=logs, out=lambda name: f"{out}/{topic(name)}", checkpoint=checkpoint,
        fmt="rows" if sink == "parquet" else "lines", sink=sink, latency=latency, delay=delay, trigger=trigger,
        kafka=(lambda name: {**(kafka or {}), "topic": topic(name)}) if sink == "kafka" else None, state_partitions=state_partitions)


def decoded(checked: DataFrame) -> DataFrame:
    """``checked`` written once as Parquet under the shared checkpoint root, so
    that results and quarantine do not each read and parse the source."""
    path = f"{scratch_path(checked.sparkSession, 'checked')}/rows"
    checked.write.parquet(path)
    return checked.sparkSession.read.schema(checked.schema).parquet(path)


def publish(checked: DataFrame, sink: str, out: str | None = None, kafka: dict[str, str] | None = None,
            quarantine: str | None = None) -> None:
    """Valid comments as keyed JSON messages; rejects to a quarantine.

    Kafka gets key (comment id) + value; files get one comment document per
    line (the key is the document's own ``commentID``), which is exactly the
    JSON-lines input ``json_comments`` reads."""
    checked = decoded(checked) if quarantine else checked
    wire = encode_wire(valid_only(checked))
    if sink == "kafka":
        write_kafka(wire, kafka or {})
    else:
        wire.select("value").write.mode("overwrite").text(out)
    if quarantine:
        rejects(checked).write.mode("overwrite").parquet(quarantine)


def start_staged(checked: DataFrame, query: str, *, stage: str, out: str, checkpoint: str,
                 sink: str = "text", latency: bool = False, delay: str = "0 seconds",
                 trigger: dict | None = None, kafka: dict[str, str] | None = None,
                 chained: bool = True, state_partitions: int | None = None) -> list[StreamingQuery]:
    """Decode/validate once into ``stage`` (valid rows + quarantine), then run
    the three results of ``query`` from the stage.

    With the default ``availableNow`` trigger the stage is completed before
    the results start; with a processing-time trigger all four run together
    and the results pick up each committed stage file."""
    ensure_dir(checked.sparkSession, stage)  # result streams may start before the first stage file
    staging = runner.start_staging(checked, stage=stage, checkpoint=f"{checkpoint}/stage", trigger=trigger)
    if not trigger or "availableNow" in trigger or "once" in trigger:
        staging.awaitTermination()
    comments = runner.staged_comments(checked.sparkSession, stage)
    return [staging] + start_streams(comments, query, out=out, checkpoint=checkpoint, sink=sink,
                                     latency=latency, delay=delay, trigger=trigger, kafka=kafka,
                                     chained=chained, state_partitions=state_partitions)
