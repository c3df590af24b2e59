"""Window alignment and the two-hour bucket on edge rows (UTC)."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from windtally.functions.timewin import DAY, DAYS30, HOUR, TWO_HOURS, WEEK, bucket_label

ROWS = [
    # create_ts,             1h start,               24h start,      7d start (Mon), 30d start,    bucket
    ("2018-01-01 00:00:00", "2018-01-01 00:00:00", "2018-01-01", "2018-01-01", "2018-01-01", "00:00:00"),
    ("2018-01-01 01:59:59", "2018-01-01 01:00:00", "2018-01-01", "2018-01-01", "2018-01-01", "00:00:00"),
    ("2018-01-01 02:00:00", "2018-01-01 02:00:00", "2018-01-01", "2018-01-01", "2018-01-01", "02:00:00"),
    ("2018-01-07 23:59:59", "2018-01-07 23:00:00", "2018-01-07", "2018-01-01", "2018-01-01", "22:00:00"),
    ("2018-01-08 00:00:00", "2018-01-08 00:00:00", "2018-01-08", "2018-01-08", "2018-01-01", "00:00:00"),
    ("2018-01-30 23:59:59", "2018-01-30 23:00:00", "2018-01-30", "2018-01-29", "2018-01-01", "22:00:00"),
    ("2018-01-31 00:00:00", "2018-01-31 00:00:00", "2018-01-31", "2018-01-29", "2018-01-31", "00:00:00"),
    ("2017-12-31 23:59:59", "2017-12-31 23:00:00", "2017-12-31", "2017-12-25", "2017-12-02", "22:00:00"),
    ("2018-03-25 01:30:00", "2018-03-25 01:00:00", "2018-03-25", "2018-03-19", "2018-03-02", "00:00:00"),
]


@pytest.fixture(scope="module")
def edge(spark):
    df = spark.createDataFrame([(r[0],) for r in ROWS], "s string").select("s", F.to_timestamp("s").alias("ts"))

    def one(spec, fmt):
        # one window expression per projection (Spark allows only one)
        rows = df.select("s", spec.over("ts").start.alias("x")).collect()
        return {r.s: fmt(r.x) for r in rows}

    h = one(HOUR, lambda x: str(x))
    d = one(DAY, lambda x: str(x.date()))
    w = one(WEEK, lambda x: str(x.date()))
    m = one(DAYS30, lambda x: str(x.date()))
    two = one(TWO_HOURS, lambda x: str(x))
    b = {r.s: r.b for r in df.select("s", bucket_label("ts").alias("b")).collect()}
    return {k: (h[k], d[k], w[k], m[k], b[k], two[k]) for k in h}


def test_edges(edge):
    for s, h, d, w, m, b in ROWS:
        assert edge[s][:5] == (h, d, w, m, b), s


def test_bucket_is_two_hour_window_start(edge):
    for v in edge.values():
        assert v[5][11:19] == v[4]


def test_chained_window_equals_direct(spark):
    df = spark.createDataFrame([(r[0],) for r in ROWS], "s string").select(F.to_timestamp("s").alias("ts"))
    fine = df.select(HOUR.over("ts").alias("window"), "ts")
    a = fine.select("ts", WEEK.over_window("window").start.alias("a"))
    b = df.select("ts", WEEK.over("ts").start.alias("b"))
    got = a.join(b, "ts").collect()
    assert len(got) == len(ROWS) and all(r.a == r.b for r in got)


def test_weeks_start_monday(spark):
    r = spark.range(1).select(WEEK.over(F.lit(datetime(2024, 1, 3, 12))).start.alias("s")).first()
    assert r.s.weekday() == 0


def test_empty_window_emits_no_row(spark):
    from windtally.plans import queries as Q
    df = spark.createDataFrame([("a", "2018-01-01 00:10:00", 1), ("b", "2018-01-01 02:10:00", 1)],
                               "article_id string, s string, depth int")
    c = df.select("article_id", F.to_timestamp("s").alias("create_ts"), "depth")
    hours = sorted(str(r.window_start) for r in Q.q1(c)["1h"].collect())
    assert hours == ["2018-01-01 00:00:00", "2018-01-01 02:00:00"]
    buckets = sorted(r.bucket for r in Q.q2(c)["24h"].collect())
    assert buckets == ["00:00:00", "02:00:00"]
