"""Text rendering of window results (one line per window).

Formats (fixed values — must match the published result lines exactly):

* label:        ``Mon Jan 01 00:00:00 UTC 2018``
* ranking line: ``<label> --> {id = A, n.comm = 5} {id = B, n.comm = 3} ``
* profile line: ``<label> --> {00:00:00, count = 4} {02:00:00, count = 9} ``
* latency:      the line followed by ``Latency = <ms>``

Every line ends with the blank that follows the last ``}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: text formats -------------------------------------------------
LABEL_PATTERN = "EEE MMM dd HH:mm:ss 'UTC' yyyy"
ARROW = " --> "
RANK_ITEM = ("{id = ", ", n.comm = ", "} ")
PROFILE_ITEM = ("{", ", count = ", "} ")
LATENCY_PREFIX = "Latency = "
# -----------------------------------------------------------------------------


def window_label(ts_ntz: Column | str) -> Column:
    """Java ``Date.toString()`` text of a UTC wall-clock timestamp."""
    return F.date_format(ts_ntz, LABEL_PATTERN)


def _items(arr: Column, key: str, parts: tuple[str, str, str]) -> Column:
    return F.array_join(
        F.transform(arr, lambda x: F.concat(F.lit(parts[0]), x[key], F.lit(parts[1]),
                                            x["n"].cast("string"), F.lit(parts[2]))),
        "")


def ranking_line(df: DataFrame, key: str = "article_id") -> DataFrame:
    """``window_start, value`` from ``ranking_array`` output."""
    line = F.concat(window_label("window_start"), F.lit(ARROW), _items(F.col("ranking"), key, RANK_ITEM))
    return _with_rest(df, line)


def profile_line(df: DataFrame, key: str = "bucket") -> DataFrame:
    """``window_start, value`` from ``ordered_profile`` output."""
    line = F.concat(window_label("window_start"), F.lit(ARROW), _items(F.col("profile"), key, PROFILE_ITEM))
    return _with_rest(df, line)


def _with_rest(df: DataFrame, line: Column) -> DataFrame:
    cols = [F.col("window_start"), line.alias("value")]
    if "max_entry_time" in df.columns:
        cols.append(F.col("max_entry_time"))
    return df.select(*cols)


def with_latency(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Append ``latency_ms = now - max_entry_time`` and, to lines, the latency text.

    ``now`` (epoch ms) is by default the clock, fixed per query execution (per
    micro-batch in a stream), so call this in the sink step, not in a reusable
    intermediate.
    """
    now = F.unix_millis(F.current_timestamp()) if now is None else now
    out = rows.withColumn("latency_ms", now - F.col("max_entry_time"))
    if "value" not in rows.columns:
        return out
    return (out.withColumn("value", F.concat(F.col("value"), F.lit(LATENCY_PREFIX),
                                          F.col("latency_ms").cast("string"))))
