"""End-to-end jobs: CSV -> JSON messages -> query 1 and 2 (batch and stream)."""

import importlib.util
import os

from windtally.plans import jobs
from windtally.plans import queries as Q
from windtally.plans.fixtures import comments_from_events
from windtally.schema import WIRE_FIELDS
from windtally.sources.comments import encode_csv

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _job(name):
    spec = importlib.util.spec_from_file_location(name, f"{ROOT}/jobs/{name}.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_batch_results_equal_single_queries(spark):
    c = comments_from_events(spark, SF_SMALL)
    rows = jobs.batch_results(spark, c, "q1", fmt="rows")
    single = Q.q1(c, chained=False)
    for w in ("1h", "24h", "7d"):
        assert sorted(rows[w].collect()) == sorted(single[w].collect())
    lines = jobs.batch_results(spark, c, "q2")
    assert set(lines) == {"24h", "7d", "30d"}
    assert all(r.value[:4] in ("Mon ", "Tue ", "Wed ", "Thu ", "Fri ", "Sat ", "Sun ") for r in lines["24h"].collect())


def test_publish_then_queries(spark, scratch):
    csv_dir, msgs, out, out2, ck = scratch("csv"), scratch("msgs"), scratch("out"), scratch("out"), scratch("ck")
    c = comments_from_events(spark, SF_SMALL)
    with open(f"{csv_dir}/comments.csv", "w") as f:
        f.write(",".join(WIRE_FIELDS) + "\n")
        f.write("\n".join(r.value for r in encode_csv(c).collect()) + "\n")
    assert _job("publish_csv").main(["--input", csv_dir, "--out", msgs], spark=spark) == 0
    assert spark.read.text(msgs).count() == c.count()
    # the published JSON lines are directly the query job's input
    assert _job("run_query").main(["query1", "--source", "json", "--input", msgs, "--out", out,
                                   "--sink", "parquet"], spark=spark) == 0
    got = spark.read.parquet(f"{out}/query1-24-hours-rank")
    want = Q.q1(c, chained=False)["24h"]
    assert sorted(got.collect()) == sorted(want.collect())
    assert _job("run_query").main(["QUERY2", "true", "--source", "events", "--input", SF_SMALL, "--out", out2,
                                   "--sink", "text", "--stream", "--checkpoint", ck], spark=spark) == 0
    lines = [r.value for r in spark.read.text(f"{out2}/query2-7-days").collect()]
    assert lines and all(" --> {" in v and "Latency = " in v for v in lines)


def test_bad_query_name_prints_usage(capsys):
    assert _job("run_query").main(["query3", "--out", "/nonexistent"]) == 2
    assert "usage" in capsys.readouterr().out


def test_staged_stream_equals_direct_stream(spark, scratch):
    """Validate once into a stage, then the three results read the stage."""
    from pyspark.sql import functions as F

    from windtally.plans.fixtures import wire_from_events
    from windtally.sources.comments import json_comments

    src, stage, out, ck, out2, ck2 = (scratch(k) for k in ("src", "stage", "out", "ck", "out", "ck"))
    wire_from_events(spark, SF_SMALL).select("value").na.fill("").write.mode("overwrite").text(f"{src}/msgs")
    checked = json_comments(spark, f"{src}/msgs", stream=True, entry_time=F.lit(0).cast("bigint"))
    handles = jobs.start_staged(checked, "q1", stage=stage, out=out, checkpoint=ck, sink="parquet")
    for h in handles:
        h.awaitTermination()
    staged = spark.read.parquet(stage)
    assert staged.filter("is_valid").count() > 0
    from windtally.streaming.runner import staged_rejects
    q = staged_rejects(spark, stage)
    assert q.columns == ["key", "value", "reject_reason"]
    assert q.filter("reject_reason = 'not_json'").filter("value is not null").count() > 0
    # same results as running the three streams on the decoded source directly
    direct = json_comments(spark, f"{src}/msgs", stream=True, entry_time=F.lit(0).cast("bigint"))
    direct = direct.filter("is_valid").drop("key", "value", "is_valid", "reject_reason")
    for h in jobs.start_streams(direct, "q1", out=out2, checkpoint=ck2, sink="parquet"):
        h.awaitTermination()
    for topic in ("query1-one-hour-rank", "query1-24-hours-rank", "query1-7-days-rank"):
        a = sorted(spark.read.parquet(f"{out}/{topic}").drop("batch").collect())
        b = sorted(spark.read.parquet(f"{out2}/{topic}").drop("batch").collect())
        assert a == b and len(a) > 0, topic


def test_batch_job_latency_rows_and_lines(spark, scratch):
    c = comments_from_events(spark, SF_SMALL)
    rows = jobs.batch_results(spark, c, "q1", latency=True, fmt="rows")
    want = Q.q1(c, latency=True, chained=False)
    for w in ("1h", "24h", "7d"):
        assert sorted(rows[w].collect()) == sorted(want[w].collect()), w
    out = scratch("out")
    jobs.write_batch(rows, "q1", "parquet", out, latency=True)
    jobs.write_batch(jobs.batch_results(spark, c, "q2", latency=True), "q2", "text", out, latency=True)
    assert spark.read.parquet(f"{out}/query1-7-days-rank").count() > 0
    assert all("Latency = " in r.value for r in spark.read.text(f"{out}/query2-30-days").collect())


def test_direct_streams_equal_chained_on_in_order_data(spark, scratch):
    from windtally.plans.fixtures import events_stream, events_to_comments
    outs = {}
    for chained in (True, False):
        out, ck = scratch("out"), scratch("ck")
        for h in jobs.start_streams(events_to_comments(events_stream(spark, SF_SMALL)), "q1", out=out,
                                    checkpoint=ck, sink="parquet", chained=chained):
            h.awaitTermination()
        outs[chained] = {t: sorted(spark.read.parquet(f"{out}/{t}").drop("batch").collect())
                         for t in ("query1-24-hours-rank", "query1-7-days-rank")}
    assert outs[True] == outs[False]


def test_staged_continuous_trigger(spark, scratch):
    """Processing-time trigger: stage and results run together, then stop."""
    from pyspark.sql import functions as F

    from windtally.plans.fixtures import wire_from_events
    from windtally.sources.comments import json_comments

    src, out, ck = scratch("src"), scratch("out"), scratch("ck")
    stage = scratch("stage") + "/not-yet-created"
    wire_from_events(spark, SF_SMALL).select("value").na.fill("").write.mode("overwrite").text(f"{src}/msgs")
    checked = json_comments(spark, f"{src}/msgs", stream=True, entry_time=F.lit(0).cast("bigint"))
    handles = jobs.start_staged(checked, "q2", stage=stage, out=out, checkpoint=ck, sink="parquet",
                                trigger={"processingTime": "1 second"})
    try:
        for h in handles:
            h.processAllAvailable()
        for h in handles:
            h.processAllAvailable()
        assert all(h.exception() is None for h in handles)
        assert spark.read.parquet(stage).count() > 0
    finally:
        for h in handles:
            h.stop()
