"""Top-3 ranking: lengths, ties, window-wide max entry time."""

from datetime import datetime

from pyspark.sql import functions as F

from windtally.operators.ranking import ranking_array, top_n

W = datetime(2018, 1, 1)


def flat(spark, rows, entry=False):
    schema = "window_start timestamp_ntz, article_id string, n bigint" + (", max_entry_time bigint" if entry else "")
    return spark.createDataFrame(rows, schema)


def ranked(df):
    return [(r.rnk, r.article_id, r.n) for r in df.orderBy("rnk").collect()]


def test_one_two_three(spark):
    assert ranked(top_n(flat(spark, [(W, "a", 1)]))) == [(1, "a", 1)]
    assert ranked(top_n(flat(spark, [(W, "a", 1), (W, "b", 4)]))) == [(1, "b", 4), (2, "a", 1)]
    assert ranked(top_n(flat(spark, [(W, "a", 1), (W, "b", 4), (W, "c", 2)]))) == [(1, "b", 4), (2, "c", 2), (3, "a", 1)]


def test_tie_at_third_place_lower_id_wins(spark):
    rows = [(W, "e", 9), (W, "d", 7), (W, "c", 5), (W, "b", 5), (W, "a", 1)]
    assert ranked(top_n(flat(spark, rows))) == [(1, "e", 9), (2, "d", 7), (3, "b", 5)]


def test_tied_counts_above_127(spark):
    rows = [(W, "x", 500), (W, "y", 500), (W, "z", 128), (W, "w", 128)]
    assert ranked(top_n(flat(spark, rows))) == [(1, "x", 500), (2, "y", 500), (3, "w", 128)]


def test_max_entry_time_from_outside_top3(spark):
    rows = [(W, "a", 9, 10), (W, "b", 8, 11), (W, "c", 7, 12), (W, "d", 1, 99)]
    out = top_n(flat(spark, rows, entry=True)).collect()
    assert len(out) == 3 and {r.max_entry_time for r in out} == {99}


def test_windows_are_independent(spark):
    w2 = datetime(2018, 1, 2)
    rows = [(W, "a", 1), (w2, "b", 2), (w2, "c", 3), (w2, "d", 4), (w2, "e", 5)]
    out = top_n(flat(spark, rows))
    assert out.filter(F.col("window_start") == W).count() == 1
    assert out.filter(F.col("window_start") == w2).count() == 3


def test_ranking_array_in_rank_order(spark):
    rows = [(W, "a", 1), (W, "b", 4), (W, "c", 2)]
    arr = ranking_array(top_n(flat(spark, rows))).first().ranking
    assert [(x.article_id, x.n) for x in arr] == [("b", 4), ("c", 2), ("a", 1)]


def test_plan_limits_before_shuffle(spark):
    rows = [(W, str(i), i) for i in range(20)]
    plan = top_n(flat(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
