"""Exact text of the result lines."""

from datetime import datetime

from windtally.functions.render import profile_line, ranking_line, with_latency
from windtally.operators.ranking import ordered_profile, ranking_array, top_n

W = datetime(2018, 1, 1)


def test_ranking_line(spark):
    df = spark.createDataFrame([(W, "art-1", 5), (W, "art-2", 3)], "window_start timestamp_ntz, article_id string, n bigint")
    line = ranking_line(ranking_array(top_n(df))).first().value
    assert line == "Mon Jan 01 00:00:00 UTC 2018 --> {id = art-1, n.comm = 5} {id = art-2, n.comm = 3} "


def test_profile_line_sorted_by_bucket(spark):
    df = spark.createDataFrame([(W, "02:00:00", 9), (W, "00:00:00", 4)], "window_start timestamp_ntz, bucket string, n bigint")
    line = profile_line(ordered_profile(df)).first().value
    assert line == "Mon Jan 01 00:00:00 UTC 2018 --> {00:00:00, count = 4} {02:00:00, count = 9} "


def test_label_of_other_days(spark):
    df = spark.createDataFrame([(datetime(2018, 4, 17), "a", 1)], "window_start timestamp_ntz, article_id string, n bigint")
    assert ranking_line(ranking_array(top_n(df))).first().value.startswith("Tue Apr 17 00:00:00 UTC 2018 --> ")


def test_latency_line(spark):
    df = spark.createDataFrame([(W, "a", 2, 1_000)], "window_start timestamp_ntz, article_id string, n bigint, max_entry_time bigint")
    r = with_latency(ranking_line(ranking_array(top_n(df)))).first()
    assert r.latency_ms > 0
    assert r.value == f"Mon Jan 01 00:00:00 UTC 2018 --> {{id = a, n.comm = 2}} Latency = {r.latency_ms}"
