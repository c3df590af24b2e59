"""CSV table reader (quoted commas), JSON-lines reader, wire encoder."""

import json

from pyspark.sql import functions as F

from windtally.operators.quality import valid_only
from windtally.schema import WIRE_FIELDS
from windtally.sources.comments import (csv_comments, encode_csv, encode_wire, json_comments, kafka_options,
                                        parse_csv_lines, validate_csv)
from windtally.sources.sinks import RESULT_TOPICS, kafka_records, kafka_sink_options, write_text

HEADER = ",".join(WIRE_FIELDS)
ROWS = [
    # plain
    '1514764900,art-1,800,1,comment,1514764800,1,false,0,,3,World,ann,7,Rome',
    # quoted with one comma
    '1514764900,art-1,800,2,comment,1514764801,1,false,0,,3,World,bob,8,"Rome, IT"',
    # quoted with two commas
    '1514764900,art-2,800,3,userReply,1514764802,2,true,2,bob,3,World,cy,9,"Rome, Lazio, IT"',
    # quoted without a comma
    '1514764900,art-2,800,4,comment,1514764803,1,false,0,,3,"World",dee,10,Paris',
    # empty last field
    '1514764900,art-3,800,5,comment,1514764804,1,false,0,,3,World,eve,11,',
    # bad number -> rejected
    '1514764900,art-3,x,6,comment,1514764805,1,false,0,,3,World,fay,12,Oslo',
]


def test_csv_reader(spark, scratch):
    d = scratch("csv")
    with open(f"{d}/comments.csv", "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS) + "\n")
    chk = csv_comments(spark, d)
    good = {r.comment_id: r for r in valid_only(chk).collect()}
    assert sorted(good) == [1, 2, 3, 4, 5]
    assert good[2].user_location == "Rome, IT"
    assert good[3].user_location == "Rome, Lazio, IT" and good[3].editors_selection is True
    assert good[4].section_name == "World"
    assert good[5].user_location == ""
    assert str(good[1].create_ts) == "2018-01-01 00:00:00"
    bad = chk.filter(~F.col("is_valid")).select("reject_reason").collect()
    assert [r.reject_reason for r in bad] == ["bad:articleWordCount"]


def test_csv_lines_roundtrip(spark, scratch):
    d = scratch("csv")
    with open(f"{d}/comments.csv", "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS[:5]) + "\n")
    typed = valid_only(csv_comments(spark, d))
    back = valid_only(validate_csv(parse_csv_lines(encode_csv(typed))))
    cols = [c for c in typed.columns if c != "entry_time"]
    assert sorted(typed.select(cols).collect()) == sorted(back.select(cols).collect())


def test_json_lines_reader(spark, scratch):
    d = scratch("json")
    docs = [{"approveDate": 1, "articleId": "a", "articleWordCount": 1, "commentID": i, "commentType": "comment",
             "createDate": 1514764800000 + i, "depth": 1, "editorsSelection": False, "inReplyTo": 0,
             "parentUserDisplayName": "", "recommendations": 0, "sectionName": "s", "userDisplayName": "u",
             "userID": 1, "userLocation": "x"} for i in range(5)]
    with open(f"{d}/part-0.json", "w") as f:
        f.write("\n".join(json.dumps(x) for x in docs) + "\nnot json\n")
    chk = json_comments(spark, d)
    assert valid_only(chk).count() == 5
    assert chk.filter("reject_reason = 'not_json'").count() == 1


def test_wire_roundtrip_keeps_key(spark):
    from windtally.schema import COMMENT_SCHEMA
    row = {f.name: None for f in COMMENT_SCHEMA.fields}
    row.update(comment_id=42, article_id="a", approve_ts=None)
    typed = spark.createDataFrame([tuple(row[f.name] for f in COMMENT_SCHEMA.fields)], COMMENT_SCHEMA)
    wire = encode_wire(typed).first()
    assert wire.key == "42" and json.loads(wire.value)["commentID"] == 42


def test_kafka_builders(spark):
    o = kafka_options("b1:9092,b2:9092", "comments", group_id="consumer")
    assert o == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "comments",
                 "startingOffsets": "earliest", "kafka.group.id": "consumer"}
    assert kafka_sink_options("b:1", RESULT_TOPICS[("q1", "1h")]) == {"kafka.bootstrap.servers": "b:1",
                                                                        "topic": "query1-one-hour-rank"}
    df = spark.createDataFrame([("k", "v", 1)], "key string, value string, x int")
    assert kafka_records(df).columns == ["key", "value"]


def test_text_sink_sorted(spark, scratch):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2018, 1, d), f"line {d}") for d in (3, 1, 2)],
                               "window_start timestamp_ntz, value string")
    out = scratch("text")
    write_text(df, out + "/r")
    import glob
    lines = [x.rstrip("\n") for p in sorted(glob.glob(out + "/r/part-*")) for x in open(p)]
    assert lines == ["line 1", "line 2", "line 3"]


def test_csv_stream(spark, scratch):
    d, out, ck = scratch("csv"), scratch("out"), scratch("ck")
    with open(f"{d}/comments.csv", "w") as f:
        f.write(HEADER + "\n" + "\n".join(ROWS) + "\n")
    stream = csv_comments(spark, d, stream=True)
    assert stream.isStreaming
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.filter("is_valid").count() == 5 and got.filter("not is_valid").count() == 1


def test_kafka_reader_names_missing_connector(spark):
    """No connector jar in this environment: the reader fails with a clear hint."""
    import pytest
    from windtally.sources.comments import kafka_comments
    try:
        kafka_comments(spark, kafka_options("localhost:1", "comments"))
    except RuntimeError as e:
        assert "spark-sql-kafka" in str(e)
    except Exception as e:  # a connector is present: building the stream must still work lazily
        pytest.fail(f"unexpected error: {e}")
