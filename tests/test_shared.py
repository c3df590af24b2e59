"""Shared closed-window logs, open windows and rescaling."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from windtally.functions.timewin import DAY
from windtally.plans import catalog_history as H
from windtally.plans.fixtures import events_to_comments
from windtally.streaming import shared, state

DAY0 = datetime(2024, 1, 1)


def comments_at(spark, rows):
    """(id, minutes after DAY0, article, depth) as events-shaped typed comments."""
    e = spark.createDataFrame([(i, DAY0 + timedelta(minutes=m), a, "click" if d == 1 else "view", 1.0) for i, m, a, d in rows],
                              "event_id long, ts timestamp, user_id long, event_type string, value double")
    return e


@pytest.fixture(scope="module")
def week(spark):
    return H.replay_shared(spark, SF_SMALL, "q1", "7d", latency=True)


def test_topic_is_read_once_and_each_level_keeps_state_once(week):
    sources = [[s["description"] for s in h.lastProgress["sources"]] for h in week["handles"]]
    assert [len(s) for s in sources] == [1, 1, 1]
    assert week["in"] in sources[0][0]
    assert f"{week['logs']}/1h" in sources[1][0] and f"{week['logs']}/24h" in sources[2][0]
    assert [len(h.lastProgress["stateOperators"]) for h in week["handles"]] == [1, 1, 1]


def test_log_holds_each_closed_window_once_and_a_heartbeat_a_commit(spark, week):
    log = spark.read.parquet(f"{week['logs']}/1h")
    rows = log.where("NOT beat")
    assert rows.groupBy("t", "key").count().where("count > 1").isEmpty()
    beats = [tuple(r) for r in log.where("beat").groupBy("batch").agg(F.count("*"), F.max("t"), F.sum("n")).orderBy("batch").collect()]
    assert all(n == 1 and total == 0 for _, n, _, total in beats)
    assert [b[2] for b in beats] == sorted({b[2] for b in beats})
    # no row's window ended at or before the heartbeat of an earlier commit
    for batch, _, mark, _ in beats:
        assert rows.where((F.col("batch") > batch) & (F.col("t") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark))).isEmpty()


def test_replayed_batch_commits_nothing_new(spark, scratch, week):
    log = f"{week['logs']}/1h"
    before = sorted(spark.read.parquet(log).inputFiles())
    batch = spark.read.parquet(log).where("batch = 1 AND NOT beat").select(
        F.struct(F.col("t").alias("start")).alias("window"), F.col("key").alias("article_id"), "n", "max_entry_time")
    shared.log_writer(log, f"{week['checkpoint']}/1h", "article_id")(batch, 1)
    assert sorted(spark.read.parquet(log).inputFiles()) == before


def test_day_closes_with_the_watermark_though_its_last_hours_are_empty(spark, scratch):
    src, logs, out, ck = (scratch(k) for k in ("in", "logs", "out", "ck"))
    for rows in ([(1, 600, 7, 1), (2, 605, 7, 2)], [(3, 1441, 8, 1)]):
        df = comments_at(spark, rows)
        df.write.mode("append").parquet(src)
        shared.start_shared(events_to_comments(spark.readStream.schema(df.schema).parquet(src)), "q1", logs=logs, out=out, checkpoint=ck,
                            wanted=("24h",))
    # hour 00:00 of day 2 is still open, yet day 1 is complete
    assert [(r.window_start, r.article_id, r.n) for r in spark.read.parquet(f"{out}/24h").collect()] == [(DAY0, "7", 2)]
    left = state.open_counts(spark, "q1", "24h", ck).collect()
    assert [(r.window_start, r.article_id, r.n) for r in left] == [(DAY0 + timedelta(days=1), "8", 1)]


def test_profiles_close_by_replies_alone(spark, scratch):
    src, logs, out, ck = (scratch(k) for k in ("in", "logs", "out", "ck"))
    df = comments_at(spark, [(1, 30, 1, 1), (2, 150, 1, 1), (3, 2000, 1, 2)])
    df.write.mode("append").parquet(src)
    shared.start_shared(events_to_comments(spark.readStream.schema(df.schema).parquet(src)), "q2", logs=logs, out=out, checkpoint=ck, wanted=("24h",))
    assert sorted((r.bucket, r.n) for r in spark.read.parquet(f"{out}/24h").collect()) == [("00:00:00", 1), ("02:00:00", 1)]


@pytest.mark.parametrize("query,window", [("q1", "24h"), ("q2", "7d")])
def test_rescaled_state_goes_on(spark, scratch, query, window):
    """A generation with other partitions ends with the counts of one run over everything."""
    e = [comments_at(spark, [(i, i * 97 + k * 4000, i % 4, 1 + i % 2) for i in range(k * 40, k * 40 + 40)]) for k in (0, 1)]
    logs, ck, src = ([scratch(f"{k}{g}") for g in (0, 1)] for k in ("logs", "ck", "in"))
    out, seeds = scratch("out"), None
    for g in (0, 1):
        e[g].write.mode("append").parquet(src[g])
        live = events_to_comments(spark.readStream.schema(e[g].schema).parquet(src[g]))
        shared.start_shared(live, query, logs=logs[g], out=f"{out}/{g}", checkpoint=ck[g], wanted=(window,), seeds=seeds, state_partitions=(2, 3)[g])
        if g == 0:
            seeds = state.seed_generation(spark, query, checkpoint=ck[0], seeds=scratch("seeds"), wanted=(window,))
    assert [state.state_partitions(spark, f"{c}/{window}") for c in ck] == [2, 3]
    both = e[0].union(e[1])
    whole = scratch("whole")
    both.write.parquet(f"{whole}/in")
    live = events_to_comments(spark.readStream.schema(both.schema).parquet(f"{whole}/in"))
    shared.start_shared(live, query, logs=f"{whole}/logs", out=f"{whole}/out", checkpoint=f"{whole}/ck", wanted=(window,))
    rows = lambda df: sorted(map(tuple, df.drop("max_entry_time").collect()))
    total = lambda closed, open_: rows(closed.union(open_))
    one = total(state.closed_counts(spark, query, window, f"{whole}/logs"), state.open_counts(spark, query, window, f"{whole}/ck"))
    closed = state.closed_counts(spark, query, window, logs[1])
    if not spark.read.parquet(f"{logs[0]}/{window}").where("NOT beat").isEmpty():
        closed = closed.union(state.closed_counts(spark, query, window, logs[0]))
    assert total(closed, state.open_counts(spark, query, window, ck[1])) == one
    assert sum(r[-1] for r in one) == both.where("event_type = 'click' OR event_type = 'view'").count() if query == "q1" else True


def test_latency_is_carried_through_the_levels(spark, week):
    by_day = spark.read.parquet(f"{week['logs']}/24h").where("NOT beat")
    want = (events_to_comments(spark.read.parquet(week["in"])).groupBy(DAY.over("create_ts")["start"].alias("t"), F.col("article_id").alias("key"))
            .agg(F.max("entry_time").alias("want")))
    assert by_day.join(want, ["t", "key"]).where("max_entry_time <> want").isEmpty()
    assert by_day.where("max_entry_time IS NULL").isEmpty()


def test_job_with_shared_logs_equals_batch(spark, scratch):
    from jobs.run_query import main
    from windtally.plans.catalog import QUERIES

    out, logs, ck = scratch("out"), scratch("logs"), scratch("ck")
    assert main(["query2", "--source", "events", "--input", SF_SMALL, "--out", out, "--sink", "text", "--stream", "--shared", logs, "--checkpoint", ck],
                spark=spark) == 0
    got = {r.value for r in spark.read.text(f"{out}/query2-24-hours").collect()}
    batch = {r.value for r in QUERIES["profile_lines_24h"](spark, SF_SMALL).collect()}
    assert got < batch and len(batch - got) == 1  # the last day is still open
