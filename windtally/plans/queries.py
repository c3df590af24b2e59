"""The two continuous queries, composed from the operators.

* **Q1** — top-3 most-commented articles per 1 h, 24 h and 7 d window
  (hierarchical: hourly counts feed daily, daily feed weekly).
* **Q2** — direct comments (depth 1) per two-hour time-of-day bucket over
  24 h, 7 d and 30 d windows, fed by one two-hour count.

Both take a typed comment frame (batch or streaming) and return DataFrames;
``latency=True`` carries ``max_entry_time`` through every aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windtally.functions.render import profile_line, ranking_line
from windtally.functions.timewin import DAY, DAYS30, HOUR, TWO_HOURS, WEEK, bucket_label
from windtally.operators.ranking import ordered_profile, ranking_array, top_n, with_window_max
from windtally.operators.rollup import count_by, flatten, hierarchy, rollup
from windtally.session import ensure_utc

Q1_SPECS = (HOUR, DAY, WEEK)
Q2_SPECS = (DAY, WEEK, DAYS30)


def direct_only(comments: DataFrame) -> DataFrame:
    """Direct comments: ``depth == 1`` (Q2 counts only these)."""
    return comments.filter(F.col("depth") == 1)


def article_counts(comments: DataFrame, latency: bool = False, chained: bool = True,
                   window_totals: bool = False) -> dict[str, DataFrame]:
    """Per-(window, article) counts for 1h / 24h / 7d (window struct kept)."""
    ensure_utc(comments.sparkSession)
    cols = ["article_id", "create_ts"] + (["entry_time"] if latency else [])
    return hierarchy(comments.select(*cols), Q1_SPECS, ["article_id"], with_entry=latency, chained=chained,
                     window_totals=window_totals)


def q1(comments: DataFrame, latency: bool = False, chained: bool = True) -> dict[str, DataFrame]:
    """Ranked rows ``window_start, rnk, article_id, n[, max_entry_time]`` per window size.

    In latency mode each level also carries its per-window totals, from which
    the ranking takes the window-wide ``max_entry_time``."""
    levels = article_counts(comments, latency, chained, window_totals=latency)
    return {name: top_n(flatten(agg)) for name, agg in levels.items()}


def q1_lines(comments: DataFrame, latency: bool = False) -> dict[str, DataFrame]:
    return {name: ranking_line(ranking_array(r)) for name, r in q1(comments, latency).items()}


def bucket_counts(comments: DataFrame, latency: bool = False) -> DataFrame:
    """Direct comments per two-hour window, labelled with its time-of-day bucket.

    The label is a function of the window start, so it is computed once per
    aggregated row instead of once per input comment, and the first shuffle
    is keyed only by the window.
    """
    ensure_utc(comments.sparkSession)  # bucket labels and window starts are UTC wall clock
    cols = ["create_ts"] + (["entry_time"] if latency else [])
    two_h = count_by(direct_only(comments).select(*cols), TWO_HOURS, with_entry=latency)
    return two_h.withColumn("bucket", bucket_label(F.col("window.start")))


def bucket_counts_all(comments: DataFrame, latency: bool = False) -> DataFrame:
    """``bucket_counts`` for streams: every comment reaches the two-hour
    aggregate and only the counting is conditional.

    In a stream all comments move the watermark, replies too.  A filter on
    depth would be pushed below the watermark and leave windows open for as
    long as only replies arrive; as there are 12 windows a day, keeping their
    state costs nothing."""
    ensure_utc(comments.sparkSession)
    direct = F.col("depth") == 1
    aggs = [F.count_if(direct).alias("n")]
    if latency:
        aggs.append(F.max(F.when(direct, F.col("entry_time"))).alias("max_entry_time"))
    two_h = comments.groupBy(TWO_HOURS.over("create_ts").alias("window")).agg(*aggs).filter("n > 0")
    return two_h.withColumn("bucket", bucket_label(F.col("window.start")))


def q2(comments: DataFrame, latency: bool = False) -> dict[str, DataFrame]:
    """Flat rows ``window_start, bucket, n[, max_entry_time]`` for 24h / 7d / 30d.

    In latency mode ``max_entry_time`` is the maximum over the whole window
    (every bucket), repeated on each of its at most 12 rows."""
    two_h = bucket_counts(comments, latency)
    out = {}
    for spec in Q2_SPECS:
        flat = flatten(rollup(two_h, spec, ["bucket"]))
        flat = flat.select("window_start", "bucket", *[c for c in flat.columns if c not in ("window_start", "bucket")])
        out[spec.name] = with_window_max(flat) if latency else flat
    return out


def q2_lines(comments: DataFrame, latency: bool = False) -> dict[str, DataFrame]:
    return {name: profile_line(ordered_profile(f)) for name, f in q2(comments, latency).items()}
