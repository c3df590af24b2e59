"""Streaming: equals batch on closed windows, late data, restart."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from windtally.plans.catalog import QUERIES
from windtally.plans.fixtures import events_stream, events_to_comments
from windtally.sources.comments import json_comments
from windtally.streaming.runner import start

from conftest import SF_SMALL


def _ms(s):
    return int(datetime.fromisoformat(s).replace(tzinfo=timezone.utc).timestamp() * 1000)


def _doc(i, ts, article):
    return json.dumps({"approveDate": _ms(ts), "articleId": article, "articleWordCount": 1, "commentID": i,
                       "commentType": "comment", "createDate": _ms(ts), "depth": 1, "editorsSelection": False,
                       "inReplyTo": 0, "parentUserDisplayName": "", "recommendations": 0, "sectionName": "s",
                       "userDisplayName": "u", "userID": 1, "userLocation": "x"})


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    out, ck = scratch("out"), scratch("ck")
    h = start(events_to_comments(events_stream(spark, SF_SMALL)), "q1", "24h", path=out, checkpoint=ck)
    h.awaitTermination()
    streamed = spark.read.parquet(out).drop("batch")
    batch = QUERIES["rank_article_24h"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 24 HOURS") <= F.lit(max_ts))
    assert sorted(streamed.collect()) == sorted(closed.collect())
    assert streamed.count() > 0


def test_late_data_three_batches(spark, scratch):
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    files = [
        [(1, "2018-01-01 00:10:00", "a"), (2, "2018-01-01 02:10:00", "a"), (3, "2018-01-01 00:20:00", "late_same_batch")],
        [(4, "2018-01-01 00:30:00", "late_next_batch"), (5, "2018-01-01 05:00:00", "a")],
        [(6, "2018-01-01 00:40:00", "late_third"), (7, "2018-01-01 06:00:00", "a")],
    ]
    for i, rows in enumerate(files):
        with open(f"{src}/f{i}.json", "w") as f:
            f.write("\n".join(_doc(*r) for r in rows) + "\n")
    # one file per micro-batch, zero delay
    comments = json_comments(spark, src, stream=True, entry_time=F.lit(0).cast("bigint"), max_files_per_trigger=1)
    comments = comments.filter("is_valid").drop("key", "value", "is_valid", "reject_reason")
    handle = start(comments, "q1", "1h", path=out, checkpoint=ck)
    handle.awaitTermination()
    from windtally.streaming.runner import dropped_late_rows
    dropped = dropped_late_rows(handle)
    res = spark.read.parquet(out)
    ids = {r.article_id for r in res.collect()}
    assert "late_same_batch" in ids and "late_next_batch" in ids
    assert "late_third" not in ids
    assert dropped == 1
    # the 06:00 window is still open: never emitted
    assert res.filter(F.hour("window_start") == 6).count() == 0


def test_restart_no_duplicates(spark, scratch):
    out, ck = scratch("out"), scratch("ck")
    c = events_to_comments(events_stream(spark, SF_SMALL))
    start(c, "q2", "24h", path=out, checkpoint=ck).awaitTermination()
    first = sorted(spark.read.parquet(out).drop("batch").collect())
    # a second run on the same checkpoint finds no new data and writes nothing new
    start(c, "q2", "24h", path=out, checkpoint=ck).awaitTermination()
    again = sorted(spark.read.parquet(out).drop("batch").collect())
    assert first == again and len(first) > 0


def test_stream_latency_rank_equals_batch(spark, scratch):
    out, ck = scratch("out"), scratch("ck")
    h = start(events_to_comments(events_stream(spark, SF_SMALL)), "q1", "24h", path=out, checkpoint=ck, latency=True)
    h.awaitTermination()
    streamed = spark.read.parquet(out).drop("batch", "latency_ms")
    assert "max_entry_time" in streamed.columns
    batch = QUERIES["rank_article_24h_entry"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 24 HOURS") <= F.lit(max_ts))
    assert sorted(streamed.collect()) == sorted(closed.collect()) and streamed.count() > 0


def test_native_profile_stream_equals_batch_lines(spark, scratch):
    from windtally.streaming.runner import profile_lines_stream, start_native

    out, ck = scratch("out"), scratch("ck")
    lines = profile_lines_stream(events_to_comments(events_stream(spark, SF_SMALL)), "24h")
    start_native(lines, checkpoint=ck, sink="parquet", path=out).awaitTermination()
    streamed = spark.read.parquet(out)
    batch = QUERIES["profile_lines_24h"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 24 HOURS") <= F.lit(max_ts))
    assert sorted(streamed.collect()) == sorted(closed.collect()) and streamed.count() > 0


def test_stream_profile_latency_rows_equal_batch(spark, scratch):
    out, ck = scratch("out"), scratch("ck")
    h = start(events_to_comments(events_stream(spark, SF_SMALL)), "q2", "7d", path=out, checkpoint=ck, latency=True)
    h.awaitTermination()
    streamed = spark.read.parquet(out).drop("batch", "latency_ms")
    batch = QUERIES["profile_7d_entry"](spark, SF_SMALL)
    max_ts = spark.read.parquet(f"{SF_SMALL}/events.parquet").agg(F.max("ts")).first()[0]
    closed = batch.filter(F.col("window_start") + F.expr("INTERVAL 7 DAYS") <= F.lit(max_ts))
    assert sorted(streamed.collect()) == sorted(closed.collect()) and streamed.count() > 0


def test_restart_mid_stream_no_missing_or_duplicate_windows(spark, scratch):
    """Stop after the first file, add more files, restart on the same
    checkpoint: the union of both runs equals one uninterrupted run."""
    files = [
        [(1, "2018-01-01 00:10:00", "a"), (2, "2018-01-01 00:50:00", "b"), (3, "2018-01-01 01:20:00", "a")],
        [(4, "2018-01-01 02:05:00", "b"), (5, "2018-01-01 02:40:00", "b"), (6, "2018-01-01 03:30:00", "c")],
        [(7, "2018-01-01 04:10:00", "a"), (8, "2018-01-01 05:55:00", "c"), (9, "2018-01-01 07:00:00", "a")],
    ]

    def write(folder, i):
        with open(f"{folder}/f{i}.json", "w") as f:
            f.write("\n".join(_doc(*r) for r in files[i]) + "\n")

    def comments(folder):
        c = json_comments(spark, folder, stream=True, entry_time=F.lit(0).cast("bigint"), max_files_per_trigger=1)
        return c.filter("is_valid").drop("key", "value", "is_valid", "reject_reason")

    # interrupted: file 0, stop; then files 1-2, restart on the same checkpoint
    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    write(src, 0)
    start(comments(src), "q1", "1h", path=out, checkpoint=ck).awaitTermination()
    write(src, 1)
    write(src, 2)
    start(comments(src), "q1", "1h", path=out, checkpoint=ck).awaitTermination()
    interrupted = sorted(spark.read.parquet(out).drop("batch").collect())

    # uninterrupted
    src2, out2, ck2 = scratch("src"), scratch("out"), scratch("ck")
    for i in range(3):
        write(src2, i)
    start(comments(src2), "q1", "1h", path=out2, checkpoint=ck2).awaitTermination()
    single = sorted(spark.read.parquet(out2).drop("batch").collect())

    assert interrupted == single and len(single) > 0
    keys = [(r.window_start, r.rnk) for r in interrupted]
    assert len(keys) == len(set(keys))  # no window emitted twice
