"""Quarantine over CSV, strict accept rules, watermark of Q2 streams, durable checkpoints."""
import importlib.util
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.test_sources import HEADER, ROWS
from windtally.functions.render import with_latency
from windtally.operators.quality import rejects, valid_only, with_validity
from windtally.sources.comments import csv_comments
from windtally.streaming import runner

JOBS = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs")


def _job(name):
    spec = importlib.util.spec_from_file_location(name, f"{JOBS}/{name}.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def _csv(scratch):
    d = scratch("csv")
    good = ROWS[0]
    with open(f"{d}/comments.csv", "w") as f:
        f.write("\n".join([HEADER, good, good.replace(good.split(",")[0], "soon", 1), good + ",extra,extra"]) + "\n")
    return d


def test_csv_quarantine_paths(spark, scratch):
    d = _csv(scratch)
    checked = csv_comments(spark, d, entry_time=F.lit(0).cast("bigint"))
    bad = rejects(checked).collect()
    assert [r.reject_reason for r in bad] == ["bad:approveDate"] and bad[0].value.startswith("soon,") and bad[0].key
    assert valid_only(checked).count() == 2  # a row with more fields keeps its first 15
    q1, q2, out = scratch("q") + "/a", scratch("q") + "/b", scratch("o")
    assert _job("publish_csv").main(["--input", d, "--out", out + "/m", "--quarantine", q1], spark=spark) == 0
    assert _job("run_query").main(["q1", "--source", "csv", "--input", d, "--out", out + "/r", "--quarantine", q2], spark=spark) == 0
    assert spark.read.parquet(q1).count() == spark.read.parquet(q2).count() == 1
    stage = scratch("stage")
    assert _job("run_query").main(["q2", "--source", "csv", "--input", d, "--out", out + "/s", "--stream", "--stage", stage,
                                   "--checkpoint", scratch("ck"), "--state-partitions", "2"], spark=spark) == 0
    assert [r.reject_reason for r in runner.staged_rejects(spark, stage).collect()] == ["bad:approveDate"]


def test_stream_needs_checkpoint(spark, scratch):
    with pytest.raises(SystemExit):
        _job("run_query").main(["q1", "--input", "x", "--out", scratch("o"), "--stream"], spark=spark)


def test_single_quoted_json_is_rejected(spark):
    df = spark.createDataFrame([("k", "{'depth': '1'}"), ("k", "[]")], "key string, value string")
    assert {r.reject_reason for r in with_validity(df).collect()} == {"not_json"}


def test_replies_close_q2_windows(spark, scratch):
    src, out, ck = scratch("in"), scratch("out"), scratch("ck")
    kind = "create_ts timestamp, depth int, entry_time bigint"
    for day in (1, 2, 3, 4):
        row = [(datetime(2024, 1, day, 10), 1 if day == 1 else 2, day)]
        spark.createDataFrame(row, kind).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
    handle = runner.start(stream, "q2", "24h", path=out, checkpoint=ck, state_partitions=2)
    handle.awaitTermination()
    assert [(r.bucket, r.n) for r in spark.read.parquet(out).collect()] == [("10:00:00", 1)]
    # one folder for the one batch that closed a window with direct comments
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) == 1


def test_latency_on_rows_and_lines(spark):
    rows = spark.createDataFrame([(1, 40)], "n int, max_entry_time bigint")
    assert with_latency(rows, F.lit(100)).collect() == [(1, 40, 60)]
    line = spark.createDataFrame([("x ", 40)], "value string, max_entry_time bigint")
    assert with_latency(line, F.lit(100)).first().value == "x Latency = 60"


def test_short_and_long_csv_rows(spark, scratch):
    d = scratch("csv")
    members = ["1", "a", "2", "3", "comment", "4", "1", "true", "0", "", "5", "s", "u", "6", '"x, ""y"""']
    with open(f"{d}/rows.csv", "w") as f:
        f.write("\n".join(",".join(m) for m in (members, members[:-1], [*members, "e", ""])) + "\n")
    got = valid_only(csv_comments(spark, d, F.lit(0).cast("bigint"), header=False)).collect()
    # an empty member stays empty in rows of any length, a missing one reads null
    assert sorted((r.parent_user_display_name, r.user_location) for r in got) == [("", "null"), ("", 'x, "y"'), ("", 'x, "y"')]
