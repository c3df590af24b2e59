"""Comment sources (S1-S3) and the keyed-JSON / CSV encoders.

* ``json_comments``  — JSON-lines files (one comment object per line), batch
  or stream; every line goes through the same validity check as the wire.
* ``kafka_comments`` — the keyed-JSON topic (``key``, ``value``) as a stream
  or batch; needs the Kafka connector on the classpath.
* ``csv_comments``   — the historical table (header + 15 columns, quoted
  fields may hold commas, epoch **seconds**).
* ``encode_wire``    — typed comments -> ``key`` (comment id) + ``value``
  (JSON, epoch **milliseconds**), ready for a Kafka or file sink.
* ``encode_csv``     — typed comments -> one CSV line per comment.

Nothing here is collected to the driver: readers are lazy scans, encoders
are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windtally.operators.quality import validate_members, with_validity
from windtally.schema import (CSV_SCHEMA, EPOCH_FIELDS, STRING_FIELDS, TYPED_NAME, WIRE_FIELDS)
from windtally.session import ensure_utc


# ------------------------------------------------------------------ JSON / wire
def envelope_from_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Text lines (one JSON object each) as a key-less envelope."""
    return lines.select(F.lit(None).cast("string").alias("key"), F.col(value_col).alias("value"))


def json_comments(spark: SparkSession, path: str, stream: bool = False,
                  entry_time: Column | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Validated comments from JSON-lines files (see ``with_validity``)."""
    ensure_utc(spark)
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        lines = r.load(path)
    else:
        lines = spark.read.text(path)
    return with_validity(envelope_from_lines(lines), entry_time)


def kafka_options(bootstrap_servers: str, topic: str, *, group_id: str | None = None,
                  starting_offsets: str = "earliest", min_partitions: int | None = None,
                  **extra: str) -> dict[str, str]:
    """Reader options for the keyed-JSON topic.

    ``min_partitions`` splits the offset ranges of a topic with few
    partitions (e.g. 3) into more Spark tasks, so JSON
    decoding is not limited to one core per topic partition."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra)
    return opts


def kafka_envelope(raw: DataFrame) -> DataFrame:
    """Kafka source rows -> ``key, value, timestamp`` strings."""
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"), "timestamp")


def kafka_comments(spark: SparkSession, options: dict[str, str], stream: bool = True,
                   entry_time: Column | None = None, entry_from: str = "clock") -> DataFrame:
    """Validated comments from the topic (requires the Kafka connector jar).

    ``entry_from="clock"`` stamps ``entry_time`` with the processing clock
    (per micro-batch); ``"broker"`` uses the record's Kafka timestamp, which
    also counts the time a record waited in the broker."""
    ensure_utc(spark)
    reader = spark.readStream if stream else spark.read
    try:
        raw = reader.format("kafka").options(**options).load()
    except Exception as e:  # connector jar absent: say which package is missing
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError(
                "The Kafka source needs the spark-sql-kafka-0-10 connector on the classpath "
                "(e.g. spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)"
            ) from e
        raise
    if entry_time is None and entry_from == "broker":
        entry_time = F.unix_millis(F.col("timestamp"))
    return with_validity(kafka_envelope(raw), entry_time)


def encode_wire(typed: DataFrame) -> DataFrame:
    """Typed comments -> ``key`` (comment id text) and ``value`` (JSON)."""
    members = []
    for f in WIRE_FIELDS:
        c = F.col(TYPED_NAME[f])
        if f in EPOCH_FIELDS:
            c = F.unix_millis(c)
        members.append(c.alias(f))
    return typed.select(F.col("comment_id").cast("string").alias("key"),
                        F.to_json(F.struct(*members)).alias("value"))


# ------------------------------------------------------------------------ CSV
# Standard RFC-4180 quoting: a quoted field may hold commas and doubled quotes.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


RAW_LINE = "_corrupt_record"


def validate_csv(rows: DataFrame, entry_time: Column | None = None) -> DataFrame:
    """Validate parsed CSV rows (15 string columns, and the raw line of those
    with another number of fields); dates are epoch seconds.

    Returns ``key`` (the comment id's text), ``value`` (the CSV line: as read
    where its number of fields is wrong, else written anew from the fields),
    the typed members and the verdict.  An empty string member, NULL to the
    CSV parser, is ``""``; a member that a short row lacks reads ``null`` if it
    is text and is rejected if it is a number."""
    raw = F.col(RAW_LINE) if RAW_LINE in rows.columns else F.lit(None).cast("string")

    # fields of a line that has too few or too many, quoted ones counted as one
    unquoted = F.regexp_replace(raw, r'"(?:[^"]++|"")*+"', "q")
    fields = F.when(raw.isNull(), len(WIRE_FIELDS)).otherwise(F.size(F.split(unquoted, ",")))

    def get(f: str) -> Column:
        there = F.when(F.col("__fields") > WIRE_FIELDS.index(f), F.lit(""))
        return F.coalesce(F.col(f), there) if f in STRING_FIELDS else F.col(f)

    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("header", "mode")}
    line = F.coalesce(raw, F.to_csv(F.struct(*WIRE_FIELDS), opts))
    staged = rows.withColumn("key", F.col("commentID")).withColumn("value", line).withColumn("__fields", fields)
    out = validate_members(staged, get, lambda f: F.lit(True), [], "s", ["key", "value"])
    et = entry_time if entry_time is not None else F.unix_millis(F.current_timestamp())
    return out.withColumn("entry_time", et)


def csv_comments(spark: SparkSession, path: str, entry_time: Column | None = None,
                 stream: bool = False, header: bool = True) -> DataFrame:
    """Validated comments from the historical CSV table (batch, or new CSV
    files arriving in ``path`` as a stream); ``header``: every file starts
    with a line of names."""
    ensure_utc(spark)
    reader = spark.readStream if stream else spark.read
    schema = T.StructType([*CSV_SCHEMA.fields, T.StructField(RAW_LINE, T.StringType())])
    rows = reader.options(**{**CSV_OPTIONS, "header": str(header).lower()}).option("columnNameOfCorruptRecord", RAW_LINE).schema(schema).csv(path)
    return validate_csv(rows, entry_time)


def csv_comments_multiline(spark: SparkSession, path: str, entry_time: Column | None = None, header: bool = True) -> DataFrame:
    """``csv_comments`` (batch) for files whose quoted fields hold line feeds; large files are read by many tasks."""
    from windtally.sources.csv_records import csv_records

    ensure_utc(spark)
    schema = T.StructType([*CSV_SCHEMA.fields, T.StructField(RAW_LINE, T.StringType())])
    opts = {**{k: v for k, v in CSV_OPTIONS.items() if k != "header"}, "columnNameOfCorruptRecord": RAW_LINE}
    parsed = F.from_csv(F.col("value"), schema.simpleString(), opts)
    # inline: a barrier, so that the parse is not repeated in every term
    return validate_csv(csv_records(spark, path, header).select(F.inline(F.array(parsed))), entry_time)


def parse_csv_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """CSV lines held in a column (e.g. from a message bus) -> 15 string columns,
    with the same parser and quoting options as ``csv_comments``."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    parsed = F.from_csv(F.col(value_col), CSV_SCHEMA.simpleString(), opts)
    return lines.select(parsed.alias("r")).select("r.*")


def encode_csv(typed: DataFrame) -> DataFrame:
    """Typed comments -> ``value`` CSV line (no header; epoch seconds)."""
    members = []
    for f in WIRE_FIELDS:
        c = F.col(TYPED_NAME[f])
        c = F.unix_seconds(c) if f in EPOCH_FIELDS else c
        members.append(c.cast("string").alias(f))
    opts = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return typed.select(F.to_csv(F.struct(*members), opts).alias("value"))
