"""Hierarchical windows equal direct ones; recorded-result invariants."""

from pyspark.sql import functions as F

from windtally.functions.timewin import DAY, DAYS30, WEEK
from windtally.operators.rollup import count_by, flatten, rollup
from windtally.plans import queries as Q
from windtally.plans.fixtures import comments_from_events, comments_from_lineitem

from conftest import SF_SMALL


def test_chained_equals_direct(spark):
    c = comments_from_events(spark, SF_SMALL)
    chained = Q.article_counts(c, chained=True)
    direct = Q.article_counts(c, chained=False)
    for w in ("1h", "24h", "7d"):
        assert sorted(flatten(chained[w]).collect()) == sorted(flatten(direct[w]).collect())


def test_profile_sums_over_week_and_30_days(spark):
    c = comments_from_lineitem(spark, SF_SMALL)
    p = Q.q2(c)
    daily = p["24h"].select(F.col("window_start").cast("timestamp").alias("ts"), "bucket", "n")
    for spec, name in ((WEEK, "7d"), (DAYS30, "30d")):
        re_summed = flatten(count_by(daily.withColumnRenamed("ts", "create_ts"), spec, ["bucket"]).drop("n")
                            .join(daily.groupBy(spec.over("ts").alias("window"), "bucket").agg(F.sum("n").alias("n")),
                                  ["window", "bucket"]))
        assert sorted(re_summed.select("window_start", "bucket", "n").collect()) == sorted(p[name].collect())


def test_latency_carries_max_entry_time(spark):
    c = comments_from_events(spark, SF_SMALL)
    two_h = Q.bucket_counts(c, latency=True)
    day = flatten(rollup(two_h, DAY, ["bucket"]))
    want = c.filter("depth = 1").agg(F.max("entry_time")).first()[0]
    assert day.agg(F.max("max_entry_time")).first()[0] == want


def test_rank_counts_non_increasing(spark):
    r = Q.q1(comments_from_events(spark, SF_SMALL))["24h"]
    rows = sorted(r.collect(), key=lambda x: (x.window_start, x.rnk))
    for a, b in zip(rows, rows[1:]):
        if a.window_start == b.window_start:
            assert a.n >= b.n and b.rnk == a.rnk + 1
    assert r.groupBy("window_start").count().agg(F.max("count")).first()[0] <= 3


def test_profile_lines_ascending_bounded_unique(spark):
    import re
    lines = Q.q2_lines(comments_from_events(spark, SF_SMALL))
    for w, df in lines.items():
        vals = [r.value for r in df.collect()]
        labels = [v.split(" --> ")[0] for v in vals]
        assert len(labels) == len(set(labels)), w
        for v in vals:
            buckets = re.findall(r"\{(\d\d:00:00), count = \d+\} ", v)
            assert buckets == sorted(buckets) and 0 < len(buckets) <= 12 and v.endswith("} ")


def test_hourly_counts_never_exceed_daily(spark):
    c = comments_from_events(spark, SF_SMALL)
    levels = {k: flatten(v) for k, v in Q.article_counts(c, chained=False).items()}
    daily = {(r.window_start.date(), r.article_id): r.n for r in levels["24h"].collect()}
    for r in levels["1h"].collect():
        assert r.n <= daily[(r.window_start.date(), r.article_id)]
