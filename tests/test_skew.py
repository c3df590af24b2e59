"""A hot key (a third of all rows) is exact and pre-aggregated before the shuffle."""

from pyspark.sql import functions as F

from windtally.plans import queries as Q


def _comments(spark, n=30_000):
    base = spark.range(n, numPartitions=6)
    hot = F.col("id") % 3 == 0  # every third row belongs to one article in one hour
    return base.select(
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("article_id"),
        F.when(hot, F.lit("2018-01-01 00:30:00").cast("timestamp"))
         .otherwise(F.timestamp_seconds(F.lit(1514764800) + F.col("id") * 17)).alias("create_ts"),
        F.lit(1).alias("depth"),
        F.col("id").alias("entry_time"),
    )


def test_hot_article_exact(spark):
    c = _comments(spark)
    r = Q.q1(c)["1h"].filter("window_start = '2018-01-01 00:00:00'").orderBy("rnk").first()
    assert (r.article_id, r.rnk) == ("hot", 1)
    want = c.filter("article_id = 'hot' and create_ts >= '2018-01-01 00:00:00' "
                    "and create_ts < '2018-01-01 01:00:00'").count()
    assert want >= 10_000 and r.n == want


def test_hot_key_partial_aggregation(spark):
    plan = Q.q1(_comments(spark))["24h"]._jdf.queryExecution().executedPlan().toString()
    # partial count runs in every map task before the (window, article) exchange
    i_partial = plan.index("partial_count")
    i_exchange = plan.index("Exchange hashpartitioning(window")
    assert i_exchange < i_partial  # tree text: the exchange is printed above its child


def test_hot_window_profile(spark):
    c = _comments(spark)
    p = Q.q2(c)["24h"].filter("window_start = '2018-01-01 00:00:00' and bucket = '00:00:00'").first()
    want = c.filter("create_ts >= '2018-01-01 00:00:00' and create_ts < '2018-01-01 02:00:00'").count()
    assert p.n == want
