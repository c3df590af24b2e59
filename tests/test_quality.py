"""Validity matrix: one row per rule (valid record, then one change each)."""

import json

import pytest

from windtally.operators.quality import rejects, valid_only, with_validity
from windtally.schema import WIRE_FIELDS

BASE = {"approveDate": 1514764900000, "articleId": "art-1", "articleWordCount": 800, "commentID": 1,
        "commentType": "comment", "createDate": 1514764800000, "depth": 1, "editorsSelection": False,
        "inReplyTo": 0, "parentUserDisplayName": "", "recommendations": 3, "sectionName": "World",
        "userDisplayName": "ann", "userID": 7, "userLocation": "Rome, IT"}


def doc(**change):
    d = dict(BASE)
    for k, v in change.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()

CASES = [
    ("v01", "k", doc(), None),
    ("v02", "k", None, "value_null"),
    ("v03", "k", "{not json", "not_json"),
    *[(f"v{4 + i:02d}", "k", doc(**{f: _DROP}), f"missing:{f}") for i, f in enumerate(WIRE_FIELDS)],
    ("v19", "k", doc(userLocation=None), None),
    ("v20", "k", doc(commentID=None), "bad:commentID"),
    ("v21", "k", doc(depth="1"), None),
    ("v22", "k", doc(depth=" 1 "), "bad:depth"),
    ("v23", "k", doc(depth=1.5), "bad:depth"),
    ("v24", "k", doc(recommendations=-4), None),
    ("v25", "k", doc(userID=-4), "bad:userID"),
    ("v26", "k", doc(userID=4294967295), None),
    ("v27", "k", doc(userID=4294967296), "bad:userID"),
    ("v28", "k", doc(recommendations=2147483648), "bad:recommendations"),
    ("v29", "k", doc(editorsSelection="maybe"), None),
    ("v30", "k", doc(createDate="abc"), "bad:createDate"),
    ("v31", "k", doc(createDate=""), "bad:createDate"),
    ("v32", "k", doc(extra=1), None),
    ("v33", None, doc(), None),
    ("x01", "k", doc(createDate=9223372036854775807), "range:createDate"),
    ("x02", "k", doc(createDate=-9223372036854775808), "range:createDate"),
    ("x03", "k", doc(approveDate=253402300800000), None),
    ("x04", "k", doc(createDate="+1514764800000"), None),
    ("x05", "k", doc(depth="1\n"), "bad:depth"),
    ("x06", "k", doc(userID="1\n"), "bad:userID"),
    ("x07", "k", doc(createDate="1514764800000\n"), "bad:createDate"),
]


@pytest.fixture(scope="module")
def checked(spark):
    df = spark.createDataFrame([(c[0], c[1], c[2]) for c in CASES], "case string, key string, value string")
    out = with_validity(df.select("key", "value"))
    rows = {(r.key, r.value): r for r in out.collect()}
    return {c[0]: rows[(c[1], c[2])] for c in CASES}


@pytest.mark.parametrize("case,key,value,reason", CASES, ids=[c[0] for c in CASES])
def test_rule(checked, case, key, value, reason):
    r = checked[case]
    assert r.reject_reason == reason
    assert r.is_valid == (reason is None)


def test_typed_values(checked):
    r = checked["v01"]
    assert r.comment_id == 1 and r.depth == 1 and r.article_id == "art-1" and r.user_location == "Rome, IT"
    assert r.create_ts.isoformat().startswith("2018-01-01T00:00")
    assert checked["v19"].user_location == "null"
    assert checked["v29"].editors_selection is False
    assert checked["v26"].user_id == 4294967295
    assert checked["v24"].recommendations == -4


def test_valid_only_and_rejects(spark):
    df = spark.createDataFrame([(c[1], c[2]) for c in CASES], "key string, value string")
    chk = with_validity(df)
    n_valid = sum(1 for c in CASES if c[3] is None)
    assert valid_only(chk).count() == n_valid
    assert rejects(chk).count() == len(CASES) - n_valid
    assert valid_only(chk).columns[-1] == "entry_time"


def test_json_parsed_once(spark):
    df = spark.createDataFrame([("k", doc())], "key string, value string")
    plan = valid_only(with_validity(df))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_broker_timestamp_kept_for_entry_time(spark):
    from datetime import datetime

    from pyspark.sql import functions as F
    df = spark.createDataFrame([("k", doc(), datetime(2018, 1, 1, 0, 0, 1))],
                               "key string, value string, timestamp timestamp")
    r = with_validity(df, F.unix_millis(F.col("timestamp"))).first()
    assert r.is_valid and r.entry_time == 1514764801000


def test_matrix_without_ansi(spark):
    """Same verdicts when the session runs with ANSI mode off (try_cast then
    behaves like the legacy cast; the text patterns keep the rules exact)."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(c[1], c[2]) for c in CASES], "key string, value string")
        got = {(r.key, r.value): r.reject_reason for r in with_validity(df).collect()}
        assert [c[0] for c in CASES if got[(c[1], c[2])] != c[3]] == []
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_odd_documents_are_parsed_once_with_the_last_of_repeated_names(spark):
    import json

    from pyspark.sql import functions as F
    from windtally.schema import WIRE_FIELDS
    doc = json.dumps({f: "1" for f in WIRE_FIELDS})
    depth = '"depth": "1"'
    cases = [
        (doc, None), (doc + " tail", None), ("  " + doc, None), (doc[:-1] + ', "depth": "7"}', None),
        (doc[:-1] + ', "depth": "x"}', "bad:depth"), (doc[:-1] + ', "depth": null}', "bad:depth"),
        (doc.replace(depth, '"depth": "x"')[:-1] + ', "depth": 7}', None), (doc.replace(depth, '"depth": 1e3'), "bad:depth"),
        (doc.replace(depth, '"depth": {"a": [1, 2]}'), "bad:depth"), (doc.replace(depth, '"depth": 7'), None),
        ("[" + doc + "]", "not_json"), (doc[:-1], "not_json"), ("{}", "missing:approveDate"), ("null", "not_json"), ("", "not_json"),
    ]
    df = spark.createDataFrame([(str(i), v) for i, (v, _) in enumerate(cases)], "key string, value string")
    checked = with_validity(df, F.lit(1))
    got = {int(r.key): r for r in checked.collect()}
    assert [got[i].reject_reason for i in range(len(cases))] == [reason for _, reason in cases]
    assert [got[i].depth for i in (0, 3, 6, 9)] == [1, 7, 7, 7]
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "json_object_keys" not in plan


def test_ingest_stamp_is_one_within_a_batch_and_rises_between_batches(spark, scratch):
    """The clock's stamp: constant in a micro-batch, later in a later one."""
    source, out, check = scratch("in"), scratch("out"), scratch("check")
    for step in range(3):
        spark.range(step * 50, step * 50 + 50).selectExpr("to_json(named_struct('n', id)) AS value").coalesce(1).write.mode("append").text(source)
        live = spark.readStream.schema("value string").format("text").load(source).selectExpr("CAST(NULL AS string) AS key", "value")
        q = (with_validity(live).select("value", "entry_time").writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", check).trigger(availableNow=True).start())
        assert q.awaitTermination(120)
    rows = spark.read.parquet(out).selectExpr("cast(get_json_object(value, '$.n') AS int) div 50 AS step", "entry_time").collect()
    stamps = {}
    for r in rows:
        stamps.setdefault(r.step, set()).add(r.entry_time)
    assert len(rows) == 150 and all(len(s) == 1 for s in stamps.values())
    assert max(stamps[0]) < max(stamps[1]) < max(stamps[2])
