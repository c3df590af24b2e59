"""Result sinks (S6, S7): text lines, Parquet tables, Kafka topics.

Batch writers are plain ``DataFrameWriter`` calls; streaming writers live in
``windtally.streaming``.  Result lines are written one window per line in
window order; the writers never gather results on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: input topic and one result topic per (query, window) ----------
INPUT_TOPIC = "comments"
RESULT_TOPICS = {
    ("q1", "1h"): "query1-one-hour-rank",
    ("q1", "24h"): "query1-24-hours-rank",
    ("q1", "7d"): "query1-7-days-rank",
    ("q2", "24h"): "query2-24-hours",
    ("q2", "7d"): "query2-7-days",
    ("q2", "30d"): "query2-30-days",
}
# -----------------------------------------------------------------------------


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Text files, one line per window, sorted by window start."""
    (lines.repartitionByRange("window_start").sortWithinPartitions("window_start")
     .select("value").write.mode(mode).text(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def kafka_sink_options(bootstrap_servers: str, topic: str, **extra: str) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}
    opts.update(extra)
    return opts


def kafka_records(df: DataFrame) -> DataFrame:
    """Keep only the Kafka record columns (``key`` optional, ``value``)."""
    cols = [F.col("value").cast("string").alias("value")]
    if "key" in df.columns:
        cols.insert(0, F.col("key").cast("string").alias("key"))
    return df.select(*cols)


def result_records(lines: DataFrame, topic: str) -> DataFrame:
    """Result lines as keyed messages.  The key names result and window, so a
    line that a replayed batch sends again has the key it had before, and a
    compacted topic or ``distinct_results`` keeps one of them."""
    start = F.date_format(F.col("window_start"), "yyyy-MM-dd'T'HH:mm:ss")
    return lines.select(F.concat(F.lit(f"{topic}|"), start).alias("key"), F.col("value").cast("string").alias("value"))


def distinct_results(messages: DataFrame) -> DataFrame:
    """One message for each result and window, whatever was sent again."""
    return messages.dropDuplicates(["key"])


def write_kafka(df: DataFrame, options: dict[str, str]) -> None:
    """Batch publish (needs the Kafka connector jar)."""
    kafka_records(df).write.format("kafka").options(**options).save()
