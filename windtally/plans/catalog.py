"""Named queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs over the whole input
tables.  ``ORACLE_SQL[name]`` is the same result written as plain SQL over
the same parquet files (views ``events``, ``lineitem``, ...), used as the
correctness gate.  Column names and types agree on both sides; window starts
are TIMESTAMP_NTZ in Spark and TIMESTAMP in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windtally.functions.render import LATENCY_PREFIX, profile_line, ranking_line, with_latency
from windtally.functions.timewin import bucket_label
from windtally.operators.ranking import ordered_profile, ranking_array
from windtally.operators.rollup import flatten
from windtally.plans import queries as Q
from windtally.operators.quality import rejects, valid_only, with_validity
from windtally.plans.fixtures import FAULTS, comments_from_events, comments_from_lineitem, csv_with_faults, wire_from_events
from windtally.plans.fixtures import table as source_table
from windtally.schema import TYPED_COLUMNS
from windtally.sources.comments import csv_comments, encode_csv, encode_wire, parse_csv_lines, validate_csv

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- SQL helpers
# DuckDB mapping of ``events`` onto comments (same rules as fixtures.py).
_EVENTS_CTE = """c AS (
  SELECT event_id AS comment_id, CAST(user_id AS VARCHAR) AS article_id, ts AS create_ts,
         CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS depth,
         epoch_us(ts) // 1000 + event_id % 1000 AS entry_time
  FROM events)"""
_LINEITEM_CTE = """c AS (
  SELECT l_orderkey AS comment_id, CAST(l_partkey AS VARCHAR) AS article_id,
         l_shipdate AS create_ts, l_linenumber AS depth, epoch_us(l_shipdate) // 1000 AS entry_time
  FROM lineitem)"""

# window-start expression per spec (origins give the same alignment as Spark)
_BUCKET = {
    "1h": "time_bucket(INTERVAL '1 hour', {c}, TIMESTAMP '1970-01-01')",
    "2h": "time_bucket(INTERVAL '2 hours', {c}, TIMESTAMP '1970-01-01')",
    "24h": "time_bucket(INTERVAL '24 hours', {c}, TIMESTAMP '1970-01-01')",
    "7d": "time_bucket(INTERVAL '7 days', {c}, TIMESTAMP '2018-01-01')",
    "30d": "time_bucket(INTERVAL '30 days', {c}, TIMESTAMP '2018-01-01')",
}
_LABEL_SQL = "lpad(CAST(hour({c}) - hour({c}) % 2 AS VARCHAR), 2, '0') || ':00:00'"
_WLABEL_SQL = "strftime(window_start, '%a %b %d %H:%M:%S UTC %Y')"


def _ws(win: str, col: str = "create_ts") -> str:
    return _BUCKET[win].format(c=col)


def _count_sql(cte: str, win: str) -> str:
    return (f"WITH {cte} SELECT {_ws(win)} AS window_start, article_id, count(*) AS n "
            f"FROM c GROUP BY ALL")


def _rank_sql(cte: str, win: str, entry: bool = False) -> str:
    agg = ", max(entry_time) AS m" if entry else ""
    wmax = ", max(m) OVER (PARTITION BY window_start) AS max_entry_time" if entry else ""
    out = ", max_entry_time" if entry else ""
    return f"""WITH {cte},
a AS (SELECT {_ws(win)} AS window_start, article_id, count(*) AS n{agg} FROM c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, article_id ASC) AS rnk{wmax} FROM a)
SELECT window_start, CAST(rnk AS INTEGER) AS rnk, article_id, n{out} FROM r WHERE rnk <= 3"""


def _profile_sql(cte: str, win: str, entry: bool = False, direct: str = "depth = 1") -> str:
    agg = ", max(entry_time) AS m" if entry else ""
    wmax = ", max(m) OVER (PARTITION BY window_start) AS max_entry_time" if entry else ""
    return f"""WITH {cte},
a AS (SELECT {_ws(win)} AS window_start, {_LABEL_SQL.format(c='create_ts')} AS bucket, count(*) AS n{agg}
      FROM c WHERE {direct} GROUP BY ALL)
SELECT window_start, bucket, n{wmax} FROM a"""


def _rank_lines_sql(cte: str, win: str) -> str:
    return f"""WITH r AS ({_rank_sql(cte, win)})
SELECT window_start, {_WLABEL_SQL} || ' --> ' ||
       string_agg('{{id = ' || article_id || ', n.comm = ' || n || '}} ', '' ORDER BY rnk) AS value
FROM r GROUP BY window_start"""


def _profile_lines_sql(cte: str, win: str) -> str:
    return f"""WITH p AS ({_profile_sql(cte, win)})
SELECT window_start, {_WLABEL_SQL} || ' --> ' ||
       string_agg('{{' || bucket || ', count = ' || n || '}} ', '' ORDER BY bucket) AS value
FROM p GROUP BY window_start"""


# ------------------------------------------------------------- Q1 (articles)
def _counts(spark, sf_dir, win, chained):
    levels = Q.article_counts(comments_from_events(spark, sf_dir), chained=chained)
    return flatten(levels[win])


for _w in ("1h", "24h", "7d"):
    # A1-A3, direct form: each window counted from the raw comments
    _register(f"count_article_{_w}", _count_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: _counts(spark, sf_dir, w, chained=False))
    # Top-3 per window
    _register(f"rank_article_{_w}", _rank_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: Q.q1(comments_from_events(spark, sf_dir), chained=False)[w])
    # Top-3 plus max ingest time over the whole window
    _register(f"rank_article_{_w}_entry", _rank_sql(_EVENTS_CTE, _w, entry=True))(
        lambda spark, sf_dir, w=_w: Q.q1(comments_from_events(spark, sf_dir), latency=True, chained=False)[w])
    # rendered ranking line per window
    _register(f"rank_lines_{_w}", _rank_lines_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: ranking_line(ranking_array(
            Q.q1(comments_from_events(spark, sf_dir), chained=False)[w])))

for _w in ("24h", "7d"):
    # Chained form (1h -> 24h -> 7d) must equal the direct form
    _register(f"rollup_article_{_w}", _count_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: _counts(spark, sf_dir, w, chained=True))


# ------------------------------------------------------------- Q2 (profiles)
@_register("direct_comments", f"WITH {_EVENTS_CTE} SELECT comment_id, article_id, create_ts FROM c WHERE depth = 1")
def _direct(spark, sf_dir):
    d = Q.direct_only(comments_from_events(spark, sf_dir))
    return d.select("comment_id", "article_id", F.col("create_ts").cast("timestamp_ntz").alias("create_ts"))


@_register("bucket_2h_label", f"WITH {_EVENTS_CTE} SELECT comment_id, {_LABEL_SQL.format(c='create_ts')} AS bucket FROM c")
def _label(spark, sf_dir):
    return comments_from_events(spark, sf_dir).select("comment_id", bucket_label("create_ts").alias("bucket"))


@_register("count_bucket_2h", _profile_sql(_EVENTS_CTE, "2h"))
def _count2h(spark, sf_dir):
    return flatten(Q.bucket_counts(comments_from_events(spark, sf_dir))).select("window_start", "bucket", "n")


for _w in ("24h", "7d", "30d"):
    # A5-A7/R3 in exploded form
    _register(f"profile_{_w}", _profile_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: Q.q2(comments_from_events(spark, sf_dir))[w])
    # Plus max ingest time over the whole window
    _register(f"profile_{_w}_entry", _profile_sql(_EVENTS_CTE, _w, entry=True))(
        lambda spark, sf_dir, w=_w: Q.q2(comments_from_events(spark, sf_dir), latency=True)[w])
    # F8: rendered profile line per window
    _register(f"profile_lines_{_w}", _profile_lines_sql(_EVENTS_CTE, _w))(
        lambda spark, sf_dir, w=_w: profile_line(ordered_profile(Q.q2(comments_from_events(spark, sf_dir))[w])))


# ------------------------------------------- larger input: lineitem mapping
_register("rank_lineitem_24h", _rank_sql(_LINEITEM_CTE, "24h"))(
    lambda spark, sf_dir: Q.q1(comments_from_lineitem(spark, sf_dir), chained=False)["24h"])
_register("rank_lineitem_7d", _rank_sql(_LINEITEM_CTE, "7d"))(
    lambda spark, sf_dir: Q.q1(comments_from_lineitem(spark, sf_dir), chained=False)["7d"])
_register("profile_lineitem_30d", _profile_sql(_LINEITEM_CTE, "30d"))(
    lambda spark, sf_dir: Q.q2(comments_from_lineitem(spark, sf_dir))["30d"])


# ---------------------------------------------- validity, quarantine, codecs
def _members_sql(ts_unit_us: int) -> str:
    """DuckDB form of the 15 typed members derived from ``events``.
    ``ts_unit_us``: precision the wire/CSV keeps for ``createDate`` (1000 = ms)."""
    return f"""SELECT
  make_timestamp((epoch_us(ts) // 1000000 + event_id % 3600) * 1000000) AS approve_ts,
  CAST(user_id AS VARCHAR) AS article_id,
  CAST(floor(value * 10) AS BIGINT) AS article_word_count,
  event_id AS comment_id,
  CASE WHEN event_type = 'click' THEN 'comment' ELSE 'userReply' END AS comment_type,
  make_timestamp(epoch_us(ts) // {ts_unit_us} * {ts_unit_us}) AS create_ts,
  CASE WHEN event_type = 'click' THEN 1 ELSE 2 END AS depth,
  event_type = 'purchase' AS editors_selection,
  CASE WHEN event_type = 'click' THEN CAST(0 AS BIGINT) ELSE event_id + 1 END AS in_reply_to,
  CASE WHEN event_type = 'click' THEN '' ELSE 'user ' || (event_id % 97) END AS parent_user_display_name,
  CAST(floor(value) AS INTEGER) AS recommendations,
  upper(left(event_type, 1)) || substr(event_type, 2) AS section_name,
  'user ' || user_id AS user_display_name,
  user_id,
  'City ' || (user_id % 50) || ', ' || upper(event_type) AS user_location,
  event_id % 20 AS fault
FROM events"""


_MEMBERS = ", ".join(c for c in TYPED_COLUMNS if c != "entry_time")
_REJECTED = ", ".join(str(k) for k, r in FAULTS.items() if r)


def _ntz(df):
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c.endswith("_ts") else F.col(c)
                       for c in df.columns])


@_register("valid_comments", f"""WITH m AS ({_members_sql(1000)})
SELECT CASE WHEN fault = 15 THEN NULL ELSE approve_ts END AS approve_ts, article_id, article_word_count, comment_id,
       comment_type, create_ts, depth,
       CASE WHEN fault = 9 THEN false ELSE editors_selection END AS editors_selection,
       in_reply_to, parent_user_display_name, recommendations, section_name, user_display_name, user_id,
       CASE WHEN fault = 12 THEN 'null' ELSE user_location END AS user_location
FROM m WHERE fault NOT IN ({_REJECTED})""")
def _valid(spark, sf_dir):
    """Typed comments that pass every rule (fault-injected wire)."""
    checked = with_validity(wire_from_events(spark, sf_dir), entry_time=F.lit(0).cast("bigint"))
    return _ntz(valid_only(checked).drop("entry_time"))


_REASON_CASE = " ".join(f"WHEN {k} THEN '{r}'" for k, r in FAULTS.items() if r)


@_register("reject_reasons", f"""SELECT CASE event_id % 20 {_REASON_CASE} END AS reject_reason, count(*) AS n
FROM events WHERE event_id % 20 IN ({_REJECTED}) GROUP BY 1""")
def _rejects(spark, sf_dir):
    """P5: quarantine rows counted per reason."""
    checked = with_validity(wire_from_events(spark, sf_dir), entry_time=F.lit(0).cast("bigint"))
    return rejects(checked).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@_register("json_roundtrip", f"WITH m AS ({_members_sql(1000)}) SELECT {_MEMBERS} FROM m")
def _json_rt(spark, sf_dir):
    """S5 then S1/P1-P3: encode every comment as keyed JSON and decode it back."""
    wire = encode_wire(comments_from_events(spark, sf_dir, spread_input=True))
    return _ntz(valid_only(with_validity(wire, F.lit(0).cast("bigint"))).drop("entry_time"))


@_register("csv_roundtrip", f"WITH m AS ({_members_sql(1000000)}) SELECT {_MEMBERS} FROM m")
def _csv_rt(spark, sf_dir):
    """Render every comment as a CSV line (quoted commas) and parse it
    back with the CSV reader's parser and options (epoch seconds)."""
    lines = encode_csv(comments_from_events(spark, sf_dir, spread_input=True))
    return _ntz(valid_only(validate_csv(parse_csv_lines(lines), F.lit(0).cast("bigint"))).drop("entry_time"))


# ------------------------------------------------------------ streaming (T, X)
def _run_stream(spark, sf_dir, query, window, change=lambda c: c):
    """Replay ``events`` as a file stream (zero-delay watermark) through the
    append-mode pipeline; return the windows it closed.  Output and state go
    to fresh folders under the shared checkpoint root."""
    from windtally.plans.fixtures import events_stream, events_to_comments
    from windtally.session import scratch_path
    from windtally.streaming.runner import start

    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    handle = start(change(events_to_comments(events_stream(spark, sf_dir))), query, window, path=out, checkpoint=ck,
                   state_partitions=spark.sparkContext.defaultParallelism)
    handle.awaitTermination()
    if handle.exception() is not None:
        raise RuntimeError(str(handle.exception()))
    return spark.read.parquet(out).drop("batch")


def _closed(sql: str, width: str) -> str:
    return (f"SELECT * FROM ({sql}) AS t "
            f"WHERE window_start + INTERVAL '{width}' <= (SELECT max(ts) FROM events)")


_register("stream_rank_7d", _closed(_rank_sql(_EVENTS_CTE, "7d"), "7 days"))(
    lambda spark, sf_dir: _run_stream(spark, sf_dir, "q1", "7d"))
_register("stream_profile_24h", _closed(_profile_sql(_EVENTS_CTE, "24h"), "24 hours"))(
    lambda spark, sf_dir: _run_stream(spark, sf_dir, "q2", "24h"))
_register("stream_rank_24h", _closed(_rank_sql(_EVENTS_CTE, "24h"), "24 hours"))(
    lambda spark, sf_dir: _run_stream(spark, sf_dir, "q1", "24h"))

# From this day on all comments are replies: they count nowhere in Q2, but they close its windows.
_REPLIES_FROM = "2024-01-25"
_REPLIES_CTE = _EVENTS_CTE.replace("event_type = 'click'", f"event_type = 'click' AND ts < TIMESTAMP '{_REPLIES_FROM}'")


def _late_replies(comments):
    return comments.withColumn("depth", F.when(F.col("create_ts") < F.lit(_REPLIES_FROM).cast("timestamp"), F.col("depth")).otherwise(2))


for _w, _width in (("24h", "24 hours"), ("7d", "7 days"), ("30d", "30 days")):
    _register(f"stream_profile_{_w}_replies", _closed(_profile_sql(_REPLIES_CTE, _w), _width))(
        lambda spark, sf_dir, w=_w: _run_stream(spark, sf_dir, "q2", w, _late_replies))


def _run_native_profile(spark, sf_dir, window):
    """Q2 lines fully in streaming state, written by the native file sink."""
    from windtally.plans.fixtures import events_stream, events_to_comments
    from windtally.session import scratch_path
    from windtally.streaming.runner import profile_lines_stream, start_native

    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    lines = profile_lines_stream(events_to_comments(events_stream(spark, sf_dir)), window)
    handle = start_native(lines, checkpoint=ck, sink="parquet", path=out,
                          state_partitions=spark.sparkContext.defaultParallelism)
    handle.awaitTermination()
    if handle.exception() is not None:
        raise RuntimeError(str(handle.exception()))
    return spark.read.parquet(out)


_register("stream_profile_lines_7d", _closed(_profile_lines_sql(_EVENTS_CTE, "7d"), "7 days"))(
    lambda spark, sf_dir: _run_native_profile(spark, sf_dir, "7d"))


def _run_stream_latency(spark, sf_dir, window):
    """Q1 with latency tracking through the stream: the ranked rows carry the
    window-wide maximum ingest time."""
    from windtally.plans.fixtures import events_stream, events_to_comments
    from windtally.session import scratch_path
    from windtally.streaming.runner import start

    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    handle = start(events_to_comments(events_stream(spark, sf_dir)), "q1", window, path=out, checkpoint=ck,
                   latency=True, state_partitions=spark.sparkContext.defaultParallelism)
    handle.awaitTermination()
    if handle.exception() is not None:
        raise RuntimeError(str(handle.exception()))
    return spark.read.parquet(out).drop("batch", "latency_ms")


_register("stream_rank_1h_entry", _closed(_rank_sql(_EVENTS_CTE, "1h", entry=True), "1 hour"))(
    lambda spark, sf_dir: _run_stream_latency(spark, sf_dir, "1h"))


# --------------------------------- the six results, from wire message to line
_VALID_CTE = _EVENTS_CTE.replace("FROM events", f"FROM events WHERE event_id % 20 NOT IN ({_REJECTED})")


def _wire_comments(spark, sf_dir):
    return valid_only(with_validity(wire_from_events(spark, sf_dir), F.lit(0).cast("bigint")))


def _lines(comments, query, window):
    if query == "q1":
        return ranking_line(ranking_array(Q.q1(comments, chained=False)[window]))
    return profile_line(ordered_profile(Q.q2(comments)[window]))


#: Event time is replayed in so many steps of so many seconds each; the last takes all the rest.
STEPS, STEP_SECONDS = 3, 10 * 86400


def _step(c, first):
    return F.least(F.floor((F.unix_seconds(c) - F.lit(first)) / STEP_SECONDS), F.lit(STEPS - 1))


def _replay(spark, table, change, query, window, fmt="rows", chained=True, distinct=False):
    """Stream ``table(step, ...)`` step by step: the rows of a step arrive as
    new files, and a run of the query (restarted on its checkpoint) takes them
    in.  Returns the windows closed over all steps."""
    from windtally.session import scratch_path
    from windtally.streaming.runner import start

    src, out, ck = (scratch_path(spark, f"stream-{k}") for k in ("in", "out", "ckpt"))
    for k in range(STEPS):
        table.where(F.col("step") == k).drop("step").write.mode("append").parquet(src)
        live = spark.readStream.schema(table.drop("step").schema).parquet(src)
        handle = start(change(live), query, window, path=out, checkpoint=ck, fmt=fmt, chained=chained, distinct=distinct,
                       state_partitions=spark.sparkContext.defaultParallelism)
        handle.awaitTermination()
        if handle.exception() is not None:
            raise RuntimeError(str(handle.exception()))
    return spark.read.parquet(out).drop("batch")


def _wire_steps(spark, sf_dir):
    """All wire messages, faults included, with the step they arrive in."""
    events = source_table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    first = events.select(F.unix_seconds(F.min("ts"))).first()[0] or 0
    return wire_from_events(spark, sf_dir).join(events, "key").select("key", "value", _step("ts", first).alias("step"))


def _stream_wire(spark, sf_dir, query, window):
    return _replay(spark, _wire_steps(spark, sf_dir), lambda live: valid_only(with_validity(live, F.lit(0).cast("bigint"))),
                   query, window, fmt="lines")


def _closed_valid(sql: str, width: str) -> str:
    return (f"SELECT * FROM ({sql}) AS t WHERE window_start + INTERVAL '{width}' <= "
            f"(SELECT max(ts) FROM events WHERE event_id % 20 NOT IN ({_REJECTED}))")


for _q, _kind, _sql, _widths in (("q1", "rank", _rank_lines_sql, {"1h": "1 hour", "24h": "24 hours", "7d": "7 days"}),
                                 ("q2", "profile", _profile_lines_sql, {"24h": "24 hours", "7d": "7 days", "30d": "30 days"})):
    for _w, _width in _widths.items():
        _register(f"wire_{_kind}_lines_{_w}", _sql(_VALID_CTE, _w))(
            lambda spark, sf_dir, q=_q, w=_w: _lines(_wire_comments(spark, sf_dir), q, w))
        _register(f"stream_wire_{_kind}_lines_{_w}", _closed_valid(_sql(_VALID_CTE, _w), _width))(
            lambda spark, sf_dir, q=_q, w=_w: _stream_wire(spark, sf_dir, q, w))


# ------------------------------------------------------------- late data (T4)
# Every tenth event arrives one step late.  A row is dropped if its hour ended
# before the largest time of all earlier steps.
_LATE_SQL = f"""WITH s AS (
  SELECT CAST(user_id AS VARCHAR) AS article_id, {_ws('1h', 'ts')} AS window_start, ts,
         least((CAST(floor(epoch(ts)) AS BIGINT) - (SELECT CAST(floor(epoch(min(ts))) AS BIGINT) FROM events)) // {STEP_SECONDS}
               + CASE WHEN event_id % 10 = 7 THEN 1 ELSE 0 END, {STEPS - 1}) AS step
  FROM events),
wm AS (SELECT k.step, max(s.ts) AS mark FROM (SELECT DISTINCT step FROM s) AS k LEFT JOIN s ON s.step < k.step GROUP BY k.step),
a AS (SELECT window_start, article_id, count(*) AS n FROM s JOIN wm USING (step)
      WHERE mark IS NULL OR window_start + INTERVAL '1 hour' > mark GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY n DESC, article_id ASC) AS rnk FROM a)
SELECT window_start, CAST(rnk AS INTEGER) AS rnk, article_id, n FROM r
WHERE rnk <= 3 AND window_start + INTERVAL '1 hour' <= (SELECT max(ts) FROM events)"""


@_register("stream_late_rank_1h", _LATE_SQL)
def _late(spark, sf_dir):
    """T4: comments that arrive after their window closed are dropped, the others count."""
    from windtally.plans.fixtures import events_to_comments

    events = source_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    first = events.select(F.unix_seconds(F.min(ts))).first()[0] or 0
    late = F.when(F.col("event_id") % 10 == 7, 1).otherwise(0)
    steps = events.withColumn("step", F.least(_step(ts, first) + late, F.lit(STEPS - 1)))
    return _replay(spark, steps, events_to_comments, "q1", "1h")


# -------------------------------------------------------- latency text
# The clock is a column: five seconds after each window's end.
def _now():
    return F.unix_millis((F.col("window_start") + F.expr("INTERVAL '24' HOUR")).cast("timestamp")) + 5000


_NOW_SQL = "epoch_us(window_start + INTERVAL '24 hours') // 1000 + 5000"


def _latency_sql(rows: str, item: str, order: str) -> str:
    return f"""WITH r AS ({rows})
SELECT window_start, max_entry_time, {_NOW_SQL} - max_entry_time AS latency_ms,
       {_WLABEL_SQL} || ' --> ' || string_agg({item}, '' ORDER BY {order}) || '{LATENCY_PREFIX}' || ({_NOW_SQL} - max_entry_time) AS value
FROM r GROUP BY window_start, max_entry_time"""


_register("rank_lines_24h_latency", _latency_sql(
    _rank_sql(_EVENTS_CTE, "24h", entry=True), "'{id = ' || article_id || ', n.comm = ' || n || '} '", "rnk"))(
    lambda spark, sf_dir: with_latency(Q.q1_lines(comments_from_events(spark, sf_dir), latency=True)["24h"], _now()))
_register("profile_lines_24h_latency", _latency_sql(
    _profile_sql(_EVENTS_CTE, "24h", entry=True), "'{' || bucket || ', count = ' || n || '} '", "bucket"))(
    lambda spark, sf_dir: with_latency(Q.q2_lines(comments_from_events(spark, sf_dir), latency=True)["24h"], _now()))


# ------------------------------------------------------------- CSV files (S3, P5)
_CSV_REASONS = {4: "bad:depth", 7: "bad:createDate"}


def _csv_files(spark, sf_dir):
    """All events as CSV files with faults (see ``csv_with_faults``), read back."""
    from windtally.session import scratch_path

    path = f"{scratch_path(spark, 'csv')}/rows"
    csv_with_faults(comments_from_events(spark, sf_dir, spread_input=True)).write.text(path)
    return csv_comments(spark, path, F.lit(0).cast("bigint"), header=False)


@_register("csv_file_comments", f"""WITH m AS ({_members_sql(1000000)})
SELECT {_MEMBERS.replace('user_location', "CASE WHEN fault = 5 THEN 'null' ELSE user_location END AS user_location")}
FROM m WHERE fault NOT IN ({', '.join(map(str, _CSV_REASONS))})""")
def _csv_valid(spark, sf_dir):
    """S3: a short row reads ``null`` for its missing text, a long one keeps its first 15 members."""
    return _ntz(valid_only(_csv_files(spark, sf_dir)).drop("entry_time"))


@_register("csv_file_rejects", f"""SELECT CASE event_id % 20 {' '.join(f"WHEN {k} THEN '{r}'" for k, r in _CSV_REASONS.items())} END AS reject_reason,
       CAST(event_id AS VARCHAR) AS key FROM events WHERE event_id % 20 IN ({', '.join(map(str, _CSV_REASONS))})""")
def _csv_rejects(spark, sf_dir):
    """P5 over S3: the quarantine's keys and reasons."""
    return rejects(_csv_files(spark, sf_dir)).select("reject_reason", "key")


from windtally.plans import catalog_history  # noqa: E402,F401  (registers its queries here)
