"""Exact lateness, incremental tables and threshold rankings against brute force."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from windtally.functions.timewin import DAY, HOUR, WEEK
from windtally.operators.lateness import late_verdicts
from windtally.operators.ranking import top_n
from windtally.operators.rollup import count_by, flatten, rollup
from windtally.operators.threshold import candidates, threshold_top_n
from windtally.plans import incremental
from windtally.plans.fixtures import events_to_comments

T0 = datetime(2024, 1, 1)


def model(rows, sources):
    """(seq, source, epoch ms or None) in order -> (seq, watermark or None, late)."""
    tops, out = {s: None for s in sources}, []
    for seq, s, ms in rows:
        mark = None if any(v is None for v in tops.values()) else min(tops.values())
        late = mark is not None and ms is not None and mark >= (ms // 3_600_000 + 1) * 3_600_000 - 1
        out.append((seq, mark, late))
        if ms is not None and (tops[s] is None or tops[s] < ms):
            tops[s] = ms
    return out


@pytest.mark.parametrize("seed,ranges", [(1, 1), (2, 7), (3, 40)])
def test_verdicts_equal_a_row_by_row_model(spark, seed, ranges):
    r = random.Random(seed)
    base = int(T0.replace(tzinfo=timezone.utc).timestamp() * 1000)
    rows, now = [], base
    for k in range(300):
        now += r.randrange(0, 900_000)
        ms = None if r.random() < 0.03 else now - (r.randrange(0, 9_000_000) if r.random() < 0.3 else 0)
        if k == 50:  # the last millisecond of an hour closes it
            ms = (now // 3_600_000 + 1) * 3_600_000 - 1
        rows.append((k, r.choice(["a", "b", None]) if k > 20 else "a", ms))
    df = spark.createDataFrame(rows, "seq long, src string, ms long").withColumn("create_ts", F.timestamp_millis("ms"))
    got = late_verdicts(df.repartition(5), HOUR, "src", ["seq"], ranges=ranges).select("seq", "watermark_ms", "is_late").collect()
    want = model(rows, {s for _, s, _ in rows})
    assert sorted(map(tuple, got)) == want
    assert any(w[2] for w in want) and any(w[1] is None for w in want)


def test_verdicts_of_no_rows_and_window_bounds(spark):
    none = spark.createDataFrame([], "seq long, src int, create_ts timestamp")
    assert late_verdicts(none, HOUR, "src", ["seq"]).collect() == []
    rows = spark.createDataFrame([(1, 1, T0)], "seq long, src int, create_ts timestamp")
    plan = late_verdicts(rows, HOUR, "src", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan  # every window is bounded by a range


# --------------------------------------------------------------- threshold
@pytest.mark.parametrize("seed", range(4))
def test_threshold_equals_full_ranking_with_ties(spark, seed):
    r = random.Random(seed)
    rows = [(T0 + timedelta(hours=r.randrange(24 * 20)), f"a{min(r.randrange(1, 40), r.randrange(1, 40)):02d}") for _ in range(600)]
    rows += [(T0 + timedelta(days=d), k) for d in range(20) for k in ("t1", "t2", "t3", "t4") for _ in range(3)]  # four keys tie
    c = spark.createDataFrame(rows, "create_ts timestamp, article_id string")
    day = count_by(c, DAY, ["article_id"]).cache()
    got = threshold_top_n(day, DAY, WEEK).collect()
    assert sorted(got) == sorted(top_n(flatten(rollup(day, WEEK, ["article_id"]))).collect())


def test_threshold_sums_few_keys_where_counts_are_skewed(spark):
    rows = [(T0 + timedelta(days=d), f"hot{k}") for d in range(7) for k in range(3) for _ in range(50)]
    rows += [(T0 + timedelta(days=i % 7), f"rare{i}") for i in range(400)]
    day = count_by(spark.createDataFrame(rows, "create_ts timestamp, article_id string"), DAY, ["article_id"])
    flat = day.select(F.col("window.start").alias("window_start"), WEEK.over_window("window")["start"].alias("coarse"), "article_id", "n")
    assert sorted(r.article_id for r in candidates(flat, WEEK, 7).collect()) == ["hot0", "hot1", "hot2"]


def test_threshold_with_fewer_keys_than_places(spark):
    day = count_by(spark.createDataFrame([(T0, "x"), (T0, None)], "create_ts timestamp, article_id string"), DAY, ["article_id"])
    assert {(r.article_id, r.n) for r in threshold_top_n(day, DAY, WEEK).collect()} == {("x", 1), (None, 1)}


# -------------------------------------------------------------- incremental
def events(spark, rows):
    return spark.createDataFrame([(i, T0 + timedelta(days=d, minutes=m), u, "click", 1.0) for i, d, m, u in rows],
                                 "event_id long, ts timestamp, user_id long, event_type string, value double")


@pytest.fixture()
def history(spark, scratch):
    folder, root = scratch("arriving"), f"{scratch('history')}/t"
    read = lambda paths: events_to_comments(spark.read.parquet(*paths))
    arrive = lambda rows: events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    add = lambda **k: incremental.add(spark, folder, root, read, **k)
    whole = lambda: events_to_comments(spark.read.parquet(folder))
    return folder, root, arrive, add, whole


def check(spark, root, whole):
    for name, spec in (("1h", HOUR), ("24h", DAY), ("7d", WEEK)):
        got = incremental.result(spark, root, "q1", name).collect()
        want = flatten(count_by(whole(), spec, ["article_id"], with_entry=True)).select("window_start", "article_id", "n", "max_entry_time").collect()
        assert sorted(got) == sorted(want), name


def test_only_touched_windows_are_rewritten(spark, history):
    folder, root, arrive, add, whole = history
    arrive([(i, i % 12, i * 7 % 1440, i % 5) for i in range(200)])
    first = add()
    assert first["files"] == 1 and add() is None  # offered again: nothing to do
    check(spark, root, whole)
    files = lambda q, w: set(spark.read.parquet(f"{root}/{q}/{w}").inputFiles())
    before = {(q, w): files(q, w) for q in ("q1", "q2") for w in incremental.WINDOWS[q]}
    arrive([(1000 + i, 2, i * 11 % 1440, 9) for i in range(20)])  # an old day
    add()
    check(spark, root, whole)
    for (q, w), old in before.items():
        start = {"24h": "2024-01-03", "1h": "2024-01-03", "7d": "2024-01-01", "30d": "2023-12-31"}[w]
        gone = {f for f in old if f not in files(q, w)}
        assert gone and all(f"start={start}" in f or w == "30d" for f in gone), (q, w, gone)
        assert {f for f in old if f"start={start}" not in f and w != "30d"} <= files(q, w)


def test_failed_increment_is_taken_over(spark, history, monkeypatch):
    folder, root, arrive, add, whole = history
    arrive([(i, i % 3, i, i % 2) for i in range(30)])
    add()
    arrive([(100 + i, 1, i, 4) for i in range(10)])
    overwrite, done = incremental._overwrite, []

    def failing(df, path, *by):
        if len(done) == 2:
            raise RuntimeError("lost")
        done.append(path)
        overwrite(df, path, *by)

    monkeypatch.setattr(incremental, "_overwrite", failing)
    with pytest.raises(RuntimeError):
        add()
    monkeypatch.setattr(incremental, "_overwrite", overwrite)
    arrive([(200 + i, 5, i, 4) for i in range(10)])  # more files: another increment id
    assert add()["files"] == 2
    check(spark, root, whole)
    assert add() is None


def test_file_without_valid_rows_is_entered(spark, history):
    folder, root, arrive, add, whole = history
    arrive([(1, 0, 0, 1)])
    add()
    arrive([])
    assert add()["touched"] == {} and add() is None
    check(spark, root, whole)
