"""Typed comment frames derived from the driver's tables.

The engine's input is a comment stream; the test tables are mapped onto the
typed comment schema with plain column expressions (no row is dropped or
sampled).  The mapping is also spelled out in SQL by the oracle catalog.

``events``:   event_id -> comment_id, user_id -> article_id (text), ts ->
create_ts, event_type 'click' -> direct comment (depth 1, others depth 2),
epoch_ms(ts) + event_id % 1000 -> entry_time (a deterministic stand-in for
the ingest clock).  The remaining text/number members are derived from the
same row so every one of the 15 members is populated.

``lineitem``: l_partkey -> article_id, l_shipdate -> create_ts,
l_linenumber -> depth, l_orderkey -> comment_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windtally.schema import TYPED_COLUMNS
from windtally.session import ensure_utc, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comments_from_events(spark: SparkSession, sf_dir: str, spread_input: bool = False) -> DataFrame:
    """All rows of ``events`` as typed comments (``COMMENT_SCHEMA`` order).

    ``spread_input`` spreads a scan with fewer splits than task slots before
    CPU-heavy per-row work (see ``session.spread``)."""
    ensure_utc(spark)
    e = table(spark, sf_dir, "events")
    return events_to_comments(spread(e) if spread_input else e)


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` read as a file stream (same schema as the batch table)."""
    ensure_utc(spark)
    r = (spark.readStream.schema(table(spark, sf_dir, "events").schema)
         .option("pathGlobFilter", "events.parquet"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(sf_dir.rstrip("/"))


def events_to_comments(e: DataFrame) -> DataFrame:
    """Typed comments from an ``events``-shaped frame (batch or stream)."""
    click = F.col("event_type") == "click"
    create_ts = F.col("ts").cast("timestamp")
    return e.select(
        F.timestamp_seconds(F.unix_seconds(create_ts) + F.col("event_id") % 3600).alias("approve_ts"),
        F.col("user_id").cast("string").alias("article_id"),
        F.floor(F.col("value") * 10).cast("bigint").alias("article_word_count"),
        F.col("event_id").alias("comment_id"),
        F.when(click, "comment").otherwise("userReply").alias("comment_type"),
        create_ts.alias("create_ts"),
        F.when(click, 1).otherwise(2).alias("depth"),
        (F.col("event_type") == "purchase").alias("editors_selection"),
        F.when(click, F.lit(0).cast("bigint")).otherwise(F.col("event_id") + 1).alias("in_reply_to"),
        F.when(click, "").otherwise(F.concat(F.lit("user "), F.col("event_id") % 97)).alias("parent_user_display_name"),
        F.floor(F.col("value")).cast("int").alias("recommendations"),
        F.initcap("event_type").alias("section_name"),
        F.concat(F.lit("user "), F.col("user_id")).alias("user_display_name"),
        F.col("user_id").alias("user_id"),
        F.concat(F.lit("City "), F.col("user_id") % 50, F.lit(", "), F.upper("event_type")).alias("user_location"),
        (F.unix_millis(create_ts) + F.col("event_id") % 1000).alias("entry_time"),
    ).select(*TYPED_COLUMNS)


def comments_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The larger benchmark input: only the members the queries read."""
    ensure_utc(spark)
    li = table(spark, sf_dir, "lineitem")
    create_ts = F.col("l_shipdate").cast("timestamp")
    return li.select(
        F.col("l_orderkey").alias("comment_id"),
        F.col("l_partkey").cast("string").alias("article_id"),
        create_ts.alias("create_ts"),
        F.col("l_linenumber").alias("depth"),
        F.unix_millis(create_ts).alias("entry_time"),
    )


# --- fault injection for the validity rules --------------------------------------
# Every ``events`` row is encoded as a wire message; ``event_id % 20`` only picks
# which rule (if any) that message breaks.  No row is skipped: all of them go
# through the validity check, valid or not.
FAULTS = {
    0: "value_null",           # message value is NULL
    1: "not_json",             # whole document behind a junk opening
    2: "missing:articleId",    # member removed
    3: "missing:userLocation",  # member removed
    4: "bad:depth",            # depth = "1.5"
    5: "bad:depth",            # depth = " 1 " (blanks)
    6: "bad:userID",           # userID = -4
    7: "bad:userID",           # userID = 4294967296
    8: "bad:recommendations",  # recommendations = 2147483648
    9: None,                   # editorsSelection = "maybe" -> valid, false
    10: "bad:createDate",      # createDate = "abc"
    11: "bad:commentID",       # commentID = null
    12: None,                  # userLocation = null -> valid, text "null"
    13: None,                  # extra unknown member -> valid
    14: "bad:approveDate",     # approveDate = ""
    15: None,                  # approveDate past year 9999 -> valid, NULL
    16: "bad:depth",           # depth = "1" and a line feed
    17: "bad:userID",          # userID = "5" and a line feed
    18: "range:createDate",    # createDate that no timestamp holds
}
# member -> {fault: replacement text (None = JSON null)}
_MEMBER_FAULTS = {
    "depth": {4: "1.5", 5: " 1 ", 16: "1\n"},
    "userID": {6: "-4", 7: "4294967296", 17: "5\n"},
    "recommendations": {8: "2147483648"},
    "editorsSelection": {9: "maybe"},
    "createDate": {10: "abc", 18: "9223372036854775807"},
    "commentID": {11: None},
    "userLocation": {12: None},
    "approveDate": {14: "", 15: "253402300800000"},
}
_REMOVED = {2: "articleId", 3: "userLocation"}


def wire_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, value`` wire messages for every ``events`` row, with faults.

    Members are carried as JSON text values (``"depth":"1"``), which the
    rules accept like bare numbers."""
    from windtally.schema import EPOCH_FIELDS, TYPED_NAME, WIRE_FIELDS

    c = comments_from_events(spark, sf_dir, spread_input=True)
    k = F.col("comment_id") % 20
    entries = []
    for f in WIRE_FIELDS:
        col = F.col(TYPED_NAME[f])
        text = (F.unix_millis(col) if f in EPOCH_FIELDS else col).cast("string")
        for fault, repl in _MEMBER_FAULTS.get(f, {}).items():
            text = F.when(k == fault, F.lit(repl).cast("string")).otherwise(text)
        entries.append(F.struct(F.lit(f).alias("k"), text.alias("v")))
    entries.append(F.struct(F.when(k == 13, F.lit("extra")).alias("k"), F.lit("x").alias("v")))
    dropped = F.lit(None).cast("string")
    for fault, member in _REMOVED.items():
        dropped = F.when(k == fault, F.lit(member)).otherwise(dropped)
    kept = F.filter(F.array(*entries),
                    lambda e: e["k"].isNotNull() & ~F.coalesce(e["k"] == dropped, F.lit(False)))
    doc = F.to_json(F.map_from_entries(kept))
    value = (F.when(k == 0, F.lit(None).cast("string"))
             .when(k == 1, F.concat(F.lit("{not json: "), doc))
             .otherwise(doc))
    return c.select(F.col("comment_id").cast("string").alias("key"), value.alias("value"))


def csv_with_faults(comments: DataFrame) -> DataFrame:
    """``value``: one CSV line per comment, without header.  ``comment_id % 20``
    picks the fault: 4 depth "1.5", 5 the last member is missing, 6 two
    members too many, 7 createDate "soon"."""
    from windtally.schema import EPOCH_FIELDS, TYPED_NAME, WIRE_FIELDS

    k = F.col("comment_id") % 20
    members = []
    for f in WIRE_FIELDS:
        c = F.col(TYPED_NAME[f])
        text = (F.unix_seconds(c) if f in EPOCH_FIELDS else c).cast("string")
        for fault, member, bad in ((4, "depth", "1.5"), (7, "createDate", "soon")):
            text = F.when(k == fault, bad).otherwise(text) if f == member else text
        members.append(text.alias(f))
    full, short = F.to_csv(F.struct(*members)), F.to_csv(F.struct(*members[:-1]))
    line = F.when(k == 5, short).when(k == 6, F.concat(full, F.lit(",extra,extra"))).otherwise(full)
    return comments.select(line.alias("value"))
