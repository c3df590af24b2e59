"""Named queries on shared logs, lateness, incremental tables and threshold rankings.

Registered through ``catalog`` (same dictionaries, same helpers)."""

from __future__ import annotations

from pyspark.sql import functions as F

from windtally.functions.timewin import DAY, HOUR, WEEK
from windtally.operators.lateness import late_verdicts
from windtally.operators.ranking import top_n
from windtally.operators.rollup import count_by, flatten
from windtally.operators.threshold import threshold_top_n
from windtally.plans import catalog as C
from windtally.plans import incremental
from windtally.plans.fixtures import comments_from_events, comments_from_lineitem, events_to_comments, table
from windtally.session import ensure_utc, scratch_path, stored

_WIDTH = {"1h": "1 hour", "24h": "24 hours", "7d": "7 days", "30d": "30 days"}


# ------------------------------------------------ shared closed-window logs
def event_steps(spark, sf_dir):
    """All events with the step they arrive in."""
    ensure_utc(spark)
    events = table(spark, sf_dir, "events")
    first = events.select(F.unix_seconds(F.min(F.col("ts").cast("timestamp")))).first()[0] or 0
    return events.withColumn("step", C._step(F.col("ts").cast("timestamp"), first))


def replay_shared(spark, sf_dir, query, wanted, latency=False):
    """Stream ``events`` step by step through the shared logs; every level is restarted on its
    checkpoint after each step.  Returns the folders and the handles of the last step."""
    from windtally.streaming.shared import start_shared

    steps = event_steps(spark, sf_dir)
    src, logs, out, ck = (scratch_path(spark, f"shared-{k}") for k in ("in", "logs", "out", "ckpt"))
    for k in range(C.STEPS):
        steps.where(F.col("step") == k).drop("step").write.mode("append").parquet(src)
        live = events_to_comments(spark.readStream.schema(steps.drop("step").schema).parquet(src))
        handles = start_shared(live, query, logs=logs, out=out, checkpoint=ck, wanted=(wanted,), latency=latency,
                               state_partitions=spark.sparkContext.defaultParallelism)
    return {"in": src, "logs": logs, "out": out, "checkpoint": ck, "handles": handles}


def _shared(spark, sf_dir, query, window):
    return spark.read.parquet(f"{replay_shared(spark, sf_dir, query, window)['out']}/{window}").drop("batch")


for _w in ("24h", "7d"):
    C._register(f"stream_shared_rank_{_w}", C._closed(C._rank_sql(C._EVENTS_CTE, _w), _WIDTH[_w]))(
        lambda spark, sf_dir, w=_w: _shared(spark, sf_dir, "q1", w))
for _w in ("24h", "7d", "30d"):
    C._register(f"stream_shared_profile_{_w}", C._closed(C._profile_sql(C._EVENTS_CTE, _w), _WIDTH[_w]))(
        lambda spark, sf_dir, w=_w: _shared(spark, sf_dir, "q2", w))


# ------------------------------------------------ open windows (X1, X2), rescaling
def _open_and_closed(spark, sf_dir, window):
    """Closed rows of the log and open rows of the state: together, every comment."""
    from windtally.streaming.state import closed_counts, open_counts

    r = replay_shared(spark, sf_dir, "q1", window)
    closed = closed_counts(spark, "q1", window, r["logs"]).select("window_start", "article_id", "n", F.lit(False).alias("is_open"))
    return closed.union(open_counts(spark, "q1", window, r["checkpoint"]).select("window_start", "article_id", "n", F.lit(True)))


for _w in ("1h", "24h"):
    C._register(f"stream_open_counts_{_w}", f"""SELECT *, window_start + INTERVAL '{_WIDTH[_w]}' > (SELECT max(ts) FROM events) AS is_open
FROM ({C._count_sql(C._EVENTS_CTE, _w)}) AS t""")(lambda spark, sf_dir, w=_w: _open_and_closed(spark, sf_dir, w))


def replay_rescaled(spark, sf_dir, window, before=2, after=5):
    """The wire messages step by step; after the first step the levels go on with ``after`` state partitions."""
    from windtally.operators.quality import valid_only, with_validity
    from windtally.streaming.shared import start_shared
    from windtally.streaming.state import seed_generation

    steps = C._wire_steps(spark, sf_dir)
    schema = steps.drop("step").schema
    src, logs, ck = ([scratch_path(spark, f"rescaled-{k}{g}") for g in (0, 1)] for k in ("in", "logs", "ckpt"))
    out, seeds = scratch_path(spark, "rescaled-out"), None
    for k in range(C.STEPS):
        g = min(k, 1)
        steps.where(F.col("step") == k).drop("step").write.mode("append").parquet(src[g])
        if k == 1:
            seeds = seed_generation(spark, "q1", checkpoint=ck[0], seeds=scratch_path(spark, "rescaled-seeds"), wanted=(window,))
        live = valid_only(with_validity(spark.readStream.schema(schema).parquet(src[g]), F.lit(0).cast("bigint")))
        start_shared(live, "q1", logs=logs[g], out=f"{out}/gen={g}", checkpoint=ck[g], wanted=(window,), fmt="lines", seeds=seeds,
                     state_partitions=(before, after)[g])
    return out, ck


@C._register("stream_rescaled_rank_lines_24h", C._closed_valid(C._rank_lines_sql(C._VALID_CTE, "24h"), "24 hours"))
def _rescaled(spark, sf_dir):
    """The state of one checkpoint goes on in another with more partitions."""
    out, _ = replay_rescaled(spark, sf_dir, "24h")
    schema = "window_start timestamp_ntz, value string"
    first, second = (spark.read.schema(schema).parquet(f"{out}/gen={g}/24h").select("window_start", "value") for g in (0, 1))
    return first.union(second)


# --------------------------------------------------- exact lateness
# Every tenth event arrives three hours late; the topic has three partitions.
_LATE_US, _SOURCES = 3 * 3600 * 1_000_000, 3
_ARRIVALS_SQL = f"""s AS (
  SELECT event_id, user_id, ts, event_id % {_SOURCES} AS src, epoch_us(ts) // 1000 AS ms,
         epoch_us(ts) + CASE WHEN event_id % 10 = 7 THEN {_LATE_US} ELSE 0 END AS arrival FROM events),
m AS (SELECT *, {", ".join(f"max(CASE WHEN src = {k} THEN ms END) OVER w AS m{k}" for k in range(_SOURCES))}
      FROM s WINDOW w AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT event_id, user_id, ts, CASE WHEN {" AND ".join(f"m{k} IS NOT NULL" for k in range(_SOURCES))}
             THEN least({", ".join(f"m{k}" for k in range(_SOURCES))}) END AS watermark_ms FROM m),
l AS (SELECT *, coalesce(watermark_ms >= epoch_us({C._ws('1h', 'ts')} + INTERVAL '1 hour') // 1000 - 1, false) AS is_late FROM v)"""


def arrivals(spark, sf_dir):
    """All events with their source partition and arrival."""
    ensure_utc(spark)
    ts = F.col("ts").cast("timestamp")
    late = F.when(F.col("event_id") % 10 == 7, _LATE_US).otherwise(0)
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").cast("string").alias("article_id"), ts.alias("create_ts"),
        (F.col("event_id") % _SOURCES).alias("src"), (F.unix_micros(ts) + late).alias("arrival"))


def _verdicts(spark, sf_dir):
    return late_verdicts(arrivals(spark, sf_dir), HOUR, "src", ["arrival", "event_id"])


C._register("late_verdicts", f"WITH {_ARRIVALS_SQL} SELECT event_id, watermark_ms, is_late FROM l")(
    lambda spark, sf_dir: _verdicts(spark, sf_dir).select("event_id", "watermark_ms", "is_late"))


@C._register("late_exact_rank_1h", f"""WITH {_ARRIVALS_SQL},
a AS (SELECT {C._ws('1h', 'ts')} AS window_start, CAST(user_id AS VARCHAR) AS article_id, count(*) AS n FROM l WHERE NOT is_late GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, article_id ASC) AS rnk FROM a)
SELECT window_start, CAST(rnk AS INTEGER) AS rnk, article_id, n FROM r WHERE rnk <= 3""")
def _exact_rank(spark, sf_dir):
    """T4 per record: comments whose hour had closed are dropped before they are counted."""
    return top_n(flatten(count_by(_verdicts(spark, sf_dir).where("NOT is_late"), HOUR, ["article_id"])))


# ------------------------------------------------------ incremental tables
# Every seventh event is an old one that arrives last; the others come in two halves of the month.
def arrival_parts(events):
    ts = F.col("ts").cast("timestamp")
    return events.withColumn("part", F.when(F.col("event_id") % 7 == 3, 2).when(F.dayofmonth(ts) <= 15, 0).otherwise(1))


def read_events(spark):
    return lambda paths: events_to_comments(spark.read.parquet(*paths))


def incremental_tables(spark, sf_dir, query, window):
    """``events`` in three parts: the first is offered twice, the last has old days."""
    ensure_utc(spark)
    folder, root = scratch_path(spark, "arriving"), f"{scratch_path(spark, 'history')}/tables"
    parts = arrival_parts(table(spark, sf_dir, "events"))
    for part in (0, None, 1, 2):
        if part is not None:
            parts.where(F.col("part") == part).drop("part").write.mode("append").parquet(folder)
        incremental.add(spark, folder, root, read_events(spark), queries=(query,), windows=(window,))
    return incremental.result(spark, root, query, window)


for _w in ("1h", "24h", "7d"):
    C._register(f"incremental_rank_{_w}", C._rank_sql(C._EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: top_n(incremental_tables(spark, sf_dir, "q1", w).drop("max_entry_time")))
for _w in ("24h", "7d", "30d"):
    C._register(f"incremental_profile_{_w}", C._profile_sql(C._EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: incremental_tables(spark, sf_dir, "q2", w).drop("max_entry_time"))


# -------------------------------------------------------- threshold top-k
def _threshold(comments):
    """7 d ranking from stored 24 h counts; the result (three rows a window) is stored, as its inputs are read several times."""
    return stored(threshold_top_n(stored(count_by(comments, DAY, ["article_id"]), "day-counts"), DAY, WEEK), "ranked")


C._register("threshold_rank_7d", C._rank_sql(C._EVENTS_CTE, "7d"))(
    lambda spark, sf_dir: _threshold(comments_from_events(spark, sf_dir).select("article_id", "create_ts")))
C._register("threshold_rank_lineitem_7d", C._rank_sql(C._LINEITEM_CTE, "7d"))(
    lambda spark, sf_dir: _threshold(comments_from_lineitem(spark, sf_dir).select("article_id", "create_ts")))


# ------------------------------------------------ messages sent again
@C._register("stream_dedup_rank_1h", C._closed(C._rank_sql(C._EVENTS_CTE, "1h"), "1 hour"))
def _dedup(spark, sf_dir):
    """Every comment counts once: some messages come twice at once, some again one or two steps later."""
    steps = event_steps(spark, sf_dir)
    again = lambda rule, later: (steps.where(rule)
                                 .withColumn("step", F.least(F.col("step") + later, F.lit(C.STEPS - 1))))
    sent = steps.unionByName(again("event_id % 5 = 0", 0)).unionByName(again("event_id % 11 = 3", 1)).unionByName(again("event_id % 13 = 4", 2))
    return C._replay(spark, sent, events_to_comments, "q1", "1h", distinct=True)


# ------------------------------------------ counts in the same pass (P5), jobs
@C._register("publish_observed", f"""SELECT 'published' AS kind, CAST(event_id AS VARCHAR) AS what, CAST(1 AS BIGINT) AS n
FROM events WHERE event_id % 20 NOT IN ({C._REJECTED})
UNION ALL SELECT 'rejected', CASE event_id % 20 {C._REASON_CASE} END, count(*) FROM events WHERE event_id % 20 IN ({C._REJECTED}) GROUP BY ALL""")
def _publish_observed(spark, sf_dir):
    """Published messages read back, and the reject counts of the pass that wrote them."""
    from windtally.operators.observed import publish_observed

    out = f"{scratch_path(spark, 'published')}/messages"
    counts = publish_observed(C.with_validity(C.wire_from_events(spark, sf_dir), F.lit(0).cast("bigint")), out)
    published = spark.read.text(out).select(F.lit("published").alias("kind"), F.get_json_object("value", "$.commentID").alias("what"),
                                            F.lit(1).cast("long").alias("n"))
    return published.union(spark.createDataFrame([("rejected", r, n) for r, n in counts.items()], "kind string, what string, n long"))


# ---------------------------------------- quoted line feeds, read in parallel
def with_line_feeds(comments):
    """Comments whose place, and every seventh's name, hold line feeds and quotes."""
    place = F.replace(F.col("user_location"), F.lit(", "), F.lit(',\n"'))
    name = F.when(F.col("comment_id") % 7 == 2, F.concat(F.lit("a\n\nb "), F.col("user_display_name"))).otherwise(F.col("user_display_name"))
    return comments.withColumn("user_location", place).withColumn("user_display_name", name)


_LF_MEMBERS = (C._MEMBERS.replace("user_display_name, user_id", "CASE WHEN comment_id % 7 = 2 THEN 'a' || chr(10) || chr(10) || 'b ' || user_display_name ELSE user_display_name END AS user_display_name, user_id")
               .replace("user_location", "replace(user_location, ', ', ',' || chr(10) || '\"') AS user_location"))


@C._register("csv_multiline_comments", f"WITH m AS ({C._members_sql(1000000)}) SELECT {_LF_MEMBERS} FROM m")
def _csv_multiline(spark, sf_dir):
    """All events as CSV files with line feeds in quoted members, read back in byte blocks."""
    from windtally.operators.quality import valid_only
    from windtally.sources.comments import csv_comments_multiline, encode_csv

    path = f"{scratch_path(spark, 'csv')}/rows"
    encode_csv(with_line_feeds(comments_from_events(spark, sf_dir, spread_input=True))).write.text(path)
    # single lines and joined ones read one exchange of the lines; stored, so that it is read back by one scan
    return stored(C._ntz(valid_only(csv_comments_multiline(spark, path, F.lit(0).cast("bigint"), header=False)).drop("entry_time")), "csv-comments")


def _job_lines(spark, sf_dir, query, window):
    """J1 as a job: the wire messages in, text files per result out, and one of them read back."""
    from windtally.plans import jobs
    from windtally.sources.sinks import RESULT_TOPICS

    out = scratch_path(spark, "job-out")
    jobs.write_batch(jobs.batch_results(spark, C._wire_comments(spark, sf_dir), query), query, "text", out)
    return spark.read.text(f"{out}/{RESULT_TOPICS[(query, window)]}")


C._register("job_query1_lines_24h", f"SELECT value FROM ({C._rank_lines_sql(C._VALID_CTE, '24h')}) AS t")(
    lambda spark, sf_dir: _job_lines(spark, sf_dir, "q1", "24h"))
C._register("job_query2_lines_7d", f"SELECT value FROM ({C._profile_lines_sql(C._VALID_CTE, '7d')}) AS t")(
    lambda spark, sf_dir: _job_lines(spark, sf_dir, "q2", "7d"))


# A typed comment holds no approveDate past year 9999 (fault 15): its message lacks the member, and a reader rejects it.
@C._register("job_publish_comments", C.ORACLE_SQL["valid_comments"] + " AND fault <> 15")
def _job_publish(spark, sf_dir):
    """J2 as a job: valid comments published as JSON lines (rejects to a quarantine) and read back as a source."""
    from windtally.operators.quality import valid_only, with_validity
    from windtally.plans import jobs
    from windtally.sources.comments import json_comments

    out = f"{scratch_path(spark, 'job-publish')}/messages"
    jobs.publish(with_validity(C.wire_from_events(spark, sf_dir), F.lit(0).cast("bigint")), "text", out, quarantine=f"{out}-rejects")
    return C._ntz(valid_only(json_comments(spark, out, entry_time=F.lit(0).cast("bigint"))).drop("entry_time"))
