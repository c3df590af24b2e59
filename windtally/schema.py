"""Comment data model.

Three shapes of the same record:

* **wire** — the 15 camelCase JSON members as published on the stream
  (timestamps in epoch milliseconds), plus the message key;
* **CSV**  — the historical table, same 15 names, timestamps in epoch seconds;
* **typed** — the snake_case columns every operator works on (``COMMENT_SCHEMA``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: member names of a comment record, in record/CSV order ----
WIRE_FIELDS = [
    "approveDate", "articleId", "articleWordCount", "commentID", "commentType",
    "createDate", "depth", "editorsSelection", "inReplyTo",
    "parentUserDisplayName", "recommendations", "sectionName",
    "userDisplayName", "userID", "userLocation",
]
# -----------------------------------------------------------------------------

# How each wire member is parsed (see operators/quality.py for the rules).
EPOCH_FIELDS = ["approveDate", "createDate"]              # signed 64-bit text
UNSIGNED_FIELDS = ["articleWordCount", "commentID", "inReplyTo", "userID"]  # 0..2^32-1
INT_FIELDS = ["depth", "recommendations"]                 # signed 32-bit
BOOL_FIELDS = ["editorsSelection"]                        # lenient: only "true" is true
STRING_FIELDS = ["articleId", "commentType", "parentUserDisplayName",
                 "sectionName", "userDisplayName", "userLocation"]

# wire name -> typed column name
TYPED_NAME = {
    "approveDate": "approve_ts",
    "articleId": "article_id",
    "articleWordCount": "article_word_count",
    "commentID": "comment_id",
    "commentType": "comment_type",
    "createDate": "create_ts",
    "depth": "depth",
    "editorsSelection": "editors_selection",
    "inReplyTo": "in_reply_to",
    "parentUserDisplayName": "parent_user_display_name",
    "recommendations": "recommendations",
    "sectionName": "section_name",
    "userDisplayName": "user_display_name",
    "userID": "user_id",
    "userLocation": "user_location",
}

_TYPED_TYPE = {
    **{f: T.TimestampType() for f in EPOCH_FIELDS},
    **{f: T.LongType() for f in UNSIGNED_FIELDS},
    **{f: T.IntegerType() for f in INT_FIELDS},
    **{f: T.BooleanType() for f in BOOL_FIELDS},
    **{f: T.StringType() for f in STRING_FIELDS},
}

COMMENT_SCHEMA = T.StructType(
    [T.StructField(TYPED_NAME[f], _TYPED_TYPE[f], True) for f in WIRE_FIELDS]
    + [T.StructField("entry_time", T.LongType(), True)]
)
TYPED_COLUMNS = [f.name for f in COMMENT_SCHEMA.fields]

# The CSV table is read as text and validated with the same rules as the wire.
CSV_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in WIRE_FIELDS])

# Kafka-shaped envelope used by the JSON/stream source.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])
