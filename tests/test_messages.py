"""Keyed result messages, messages sent again, validity counts of the same pass."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from windtally.operators.observed import RejectGuard, RejectShareExceeded, observed, publish_observed, reasons, reject_counts
from windtally.operators.quality import field_checks, rejects, valid_only, with_validity
from windtally.plans.fixtures import wire_from_events
from windtally.sources.comments import json_comments
from windtally.sources.sinks import distinct_results, result_records
from windtally.streaming.runner import start_staging, window_counts

from test_quality import CASES


def wire(spark):
    return spark.createDataFrame([(c[1], c[2]) for c in CASES], "key string, value string")


# ------------------------------------------------------------- result messages
def test_result_key_names_result_and_window(spark):
    lines = spark.createDataFrame([(datetime(2024, 1, 1), "a"), (datetime(2024, 1, 1, 1), "b")], "window_start timestamp_ntz, value string")
    got = result_records(lines, "query1-one-hour-rank")
    assert sorted(map(tuple, got.collect())) == [("query1-one-hour-rank|2024-01-01T00:00:00", "a"), ("query1-one-hour-rank|2024-01-01T01:00:00", "b")]
    # a replayed batch sends a line again, perhaps with another latency text
    again = got.union(got).union(result_records(lines.withColumn("value", F.lit("b Latency = 9")), "query1-one-hour-rank"))
    assert sorted(r.key for r in distinct_results(again).collect()) == sorted(r.key for r in got.collect())


@pytest.mark.parametrize("parts", [1, 3])
def test_comments_sent_again_count_once(spark, scratch, parts):
    """Copies in one batch, in the next one and long after: against a set of ids."""
    src, ck, out = scratch("src"), scratch("ck"), scratch("out")
    schema = "comment_id long, article_id string, create_ts timestamp, depth int, entry_time long"
    base = datetime(2024, 1, 1).timestamp()
    row = lambda i: (i, f"a{i % 3}", datetime.fromtimestamp(base + i * 600), 1, 0)
    batches = [[0, 1, 2, 3, 1, 1], [3, 4, 9, 2, 10], [20, 4, 9, 0, 21, 20], [40, 1, 20, 41]]
    for ids in batches:
        spark.createDataFrame([row(i) for i in ids], schema).repartition(parts).write.mode("append").parquet(src)
        counts = window_counts(spark.readStream.schema(schema).parquet(src), "q1", "1h", distinct=True)
        h = (counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        h.awaitTermination()
    ids = {i for b in batches for i in b if i * 600 // 3600 * 3600 + 3600 <= 41 * 600}
    want = {}
    for i in ids:
        k = (i * 600 // 3600, f"a{i % 3}")
        want[k] = want.get(k, 0) + 1
    got = {((r.window.start.timestamp() - base) // 3600, r.article_id): r.n for r in spark.read.parquet(out).collect()}
    assert got == want


# ------------------------------------------------------------ counts of the pass
def test_reasons_are_those_of_the_rules():
    assert reasons()[2:] == [r for _, r in field_checks(lambda f: F.lit("x"), lambda f: F.lit(True))]


def test_observed_counts_equal_a_second_pass_and_scan_once(spark, scratch):
    path = scratch("wire")
    wire_from_events(spark, SF_SMALL).write.mode("append").parquet(path)
    checked = with_validity(spark.read.parquet(path), F.lit(0).cast("bigint"))
    rows, seen = observed(checked)
    valid = valid_only(rows)
    assert valid._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    n = valid.count()
    metrics = seen.get
    assert (metrics["rows"], metrics["valid"]) == (checked.count(), n)
    assert reject_counts(metrics) == {r.reject_reason: r["count"] for r in rejects(checked).groupBy("reject_reason").count().collect()}


def test_publish_fails_on_too_many_rejects_and_shows_nothing(spark, scratch):
    checked = with_validity(wire(spark), F.lit(0).cast("bigint"))
    bad = sum(1 for c in CASES if c[3])
    out = f"{scratch('pub')}/messages"
    with pytest.raises(RejectShareExceeded):
        publish_observed(checked, out, max_share=(bad - 1) / len(CASES))
    assert not os.path.exists(out)
    counts = publish_observed(checked, out, max_share=bad / len(CASES))
    assert sum(counts.values()) == bad and spark.read.text(out).count() == len(CASES) - bad
    empty = f"{scratch('pub')}/messages"
    assert publish_observed(checked.limit(0), empty, max_share=0.0) == {} and spark.read.text(empty).count() == 0


def test_stream_guard_counts_and_stops(spark, scratch):
    src = scratch("src")
    for k in range(3):
        wire(spark).where("value is not null").select("value").coalesce(1).write.mode("append").text(src)
    for share, fails in ((1.0, False), (0.1, True)):
        guard = RejectGuard(max_share=share)
        spark.streams.addListener(guard)
        try:
            checked = guard.watch(json_comments(spark, src, stream=True, entry_time=F.lit(0).cast("bigint"), max_files_per_trigger=1))
            h = start_staging(checked, stage=scratch("stage"), checkpoint=scratch("ck"))
            h.awaitTermination(60)
            for _ in range(100):  # progress is told a little after the batch
                if len(guard.batches) == 3 or guard.tripped:
                    break
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(guard)
        if fails:
            assert guard.tripped
            with pytest.raises(RejectShareExceeded):
                guard.check()
        else:
            guard.check()
            assert guard.total("rows") == 3 * (len(CASES) - 1) and not guard.tripped
            assert sum(guard.rejects().values()) == 3 * sum(1 for c in CASES if c[3] and c[2] is not None)


def test_ingest_stamp_is_constant_in_a_batch_and_rises_between_them(spark, scratch):
    src, seen = scratch("src"), {}
    for k in range(3):
        wire(spark).where("value is not null").select("value").repartition(2).write.mode("append").text(src)
    checked = json_comments(spark, src, stream=True, max_files_per_trigger=2)

    def note(batch, batch_id):
        seen[batch_id] = {r[0] for r in batch.select("entry_time").distinct().collect()}

    before = int(time.time() * 1000)
    checked.writeStream.foreachBatch(note).option("checkpointLocation", scratch("ck")).trigger(availableNow=True).start().awaitTermination()
    stamps = [seen[k] for k in sorted(seen)]
    assert len(stamps) == 3 and all(len(s) == 1 for s in stamps)
    times = [s.pop() for s in stamps]
    assert before <= times[0] < times[1] < times[2] <= int(time.time() * 1000)


def test_scratch_folders_are_listed_by_age(spark, tmp_path):
    from windtally.session import expired_scratch

    for name in ("stage-" + "0" * 32, "mine", "tokens-" + "a1" * 16):
        (tmp_path / name).mkdir()
    assert expired_scratch(spark, 1, str(tmp_path)) == []
    assert [p.rsplit("/", 1)[1] for p in expired_scratch(spark, -1, str(tmp_path))] == ["stage-" + "0" * 32, "tokens-" + "a1" * 16]
