"""Per-window top-N ranking and ordered time-of-day profiles.

``top_n`` is ``row_number() <= n`` over ``partition by window_start``.
Catalyst turns the filter into a ``WindowGroupLimit`` that keeps only ``n``
rows per window inside every map task *before* the shuffle, so a window with
millions of articles still sends at most ``n`` rows per task to the final
ranking — no single task ever gathers a whole window.

Tie order (a deliberate, documented choice): count descending, then key
ascending, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windtally.operators.rollup import ENTRY, TOTAL

# --- fixed value: ranking length ----------------------------------------------
TOP_N = 3
# -----------------------------------------------------------------------------


def top_n(flat: DataFrame, n: int = TOP_N, key: str = "article_id") -> DataFrame:
    """``window_start, rnk, key, n[, max_entry_time]``; rows with ``rnk <= n``.

    Latency variant: the input must also hold the per-window total rows of
    a ``window_totals`` aggregate (``window_total = 1``).  Those rows sort
    first in each window, so the same ``WindowGroupLimit`` keeps ``n + 1``
    rows, and their ``max_entry_time`` — the maximum over *every* key of the
    window, including keys outside the top ``n`` — is spread to the ranked
    rows by a second window over those few rows.  One scan, no self-join.
    """
    if ENTRY in flat.columns and TOTAL not in flat.columns:
        flat = with_totals(flat, key)
    if TOTAL not in flat.columns:
        w = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col(key).asc())
        return (flat.select("window_start", key, "n")
                .withColumn("rnk", F.row_number().over(w))
                .filter(F.col("rnk") <= n)
                .select("window_start", "rnk", key, "n"))
    w = Window.partitionBy("window_start").orderBy(F.col(TOTAL).desc(), F.col("n").desc(), F.col(key).asc())
    kept = (flat.select("window_start", key, "n", ENTRY, TOTAL)
            .withColumn("pos", F.row_number().over(w))
            .filter(F.col("pos") <= n + 1))
    latest = F.max(F.when(F.col(TOTAL) == 1, F.col(ENTRY))).over(Window.partitionBy("window_start"))
    return (kept.withColumn("window_max", latest)
            .filter(F.col(TOTAL) == 0)
            .select("window_start", (F.col("pos") - 1).alias("rnk"), key, "n",
                    F.col("window_max").alias(ENTRY)))


def with_totals(flat: DataFrame, key: str = "article_id") -> DataFrame:
    """Add per-window total rows to keyed rows that lack them.

    A second pass over ``flat``: meant for small inputs such as one
    micro-batch in ``foreachBatch``.  Whole-table jobs get the totals from the
    grouping-sets aggregate instead (``window_totals=True``)."""
    keyed = flat.select("window_start", key, "n", ENTRY, F.lit(0).alias(TOTAL))
    totals = flat.groupBy("window_start").agg(
        F.lit(None).cast(flat.schema[key].dataType).alias(key), F.sum("n").alias("n"),
        F.max(ENTRY).alias(ENTRY), F.lit(1).alias(TOTAL))
    return keyed.unionByName(totals)


def ordered_profile(flat: DataFrame, key: str = "bucket") -> DataFrame:
    """One row per window with ``profile: array<struct<bucket, n>>`` sorted by
    bucket.  At most 12 two-hour buckets exist per window, so the array is
    bounded whatever the data volume."""
    aggs = [F.array_sort(F.collect_list(F.struct(F.col(key).alias(key), F.col("n")))).alias("profile")]
    if ENTRY in flat.columns:
        aggs.append(F.max(ENTRY).alias(ENTRY))
    return flat.groupBy("window_start").agg(*aggs)


def ranking_array(ranked: DataFrame, key: str = "article_id") -> DataFrame:
    """Collapse ``top_n`` rows to ``window_start, ranking: array<struct>`` in
    rank order (at most ``n`` elements per window)."""
    aggs = [F.transform(
        F.array_sort(F.collect_list(F.struct(F.col("rnk"), F.col(key), F.col("n")))),
        lambda x: F.struct(x[key].alias(key), x["n"].alias("n")),
    ).alias("ranking")]
    if ENTRY in ranked.columns:
        aggs.append(F.max(ENTRY).alias(ENTRY))
    return ranked.groupBy("window_start").agg(*aggs)


def with_window_max(flat: DataFrame) -> DataFrame:
    """Replace a per-row ``max_entry_time`` by the maximum over its window.

    Used on profile rows (at most 12 per window), so the window partition is
    bounded."""
    return flat.withColumn(ENTRY, F.max(ENTRY).over(Window.partitionBy("window_start")))
