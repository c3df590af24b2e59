"""Keyed counts per tumbling window, direct and hierarchical.

``count_by`` is the first level (one row per (window, key) with ``n`` and,
in latency mode, ``max_entry_time``).  ``rollup`` re-aggregates such a result
into a coarser aligned window; because every coarse window is a union of fine
ones, ``rollup(count_by(df, HOUR), DAY) == count_by(df, DAY)``.

Both lower to a partial (map-side) + final ``HashAggregate`` around one
shuffle on (window, key): a hot key is pre-combined in every map task, so at
most one row per (map task, window, key) crosses the network.  The rollup
levels shuffle the already-aggregated rows, which are orders of magnitude
fewer than the input comments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windtally.functions.timewin import WindowSpec

ENTRY = "max_entry_time"
TOTAL = "window_total"


def _grouped(framed: DataFrame, keys: Sequence[str], aggs: list, window_totals: bool) -> DataFrame:
    """Aggregate per (window, keys); with ``window_totals`` also one row per
    window over all keys (keys NULL, ``window_total = 1``) from the *same*
    aggregate — one scan, one shuffle (grouping sets)."""
    if not window_totals or not keys:
        return framed.groupBy("window", *keys).agg(*aggs)
    g = framed.groupingSets([["window", *keys], ["window"]], "window", *keys)
    return g.agg(*aggs, F.grouping(keys[0]).cast("int").alias(TOTAL))


def count_by(df: DataFrame, spec: WindowSpec, keys: Sequence[str] = (),
             time_col: str = "create_ts", with_entry: bool = False,
             window_totals: bool = False) -> DataFrame:
    """Rows per (``spec`` window, keys): columns ``window, *keys, n[, max_entry_time]``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    cols = [spec.over(time_col).alias("window"), *keys]
    if with_entry:
        aggs.append(F.max("entry_time").alias(ENTRY))
        cols.append("entry_time")
    if not window_totals:
        return df.groupBy(cols[0], *keys).agg(*aggs)
    return _grouped(df.select(*cols), keys, aggs, window_totals)


def rollup(agg: DataFrame, spec: WindowSpec, keys: Sequence[str] = (),
           window_totals: bool = False) -> DataFrame:
    """Re-aggregate a ``count_by``/``rollup`` result into the coarser ``spec``."""
    aggs = [F.sum("n").alias("n")]
    extra = []
    if ENTRY in agg.columns:
        aggs.append(F.max(ENTRY).alias(ENTRY))
        extra.append(ENTRY)
    if not window_totals:
        return agg.groupBy(spec.over_window("window").alias("window"), *keys).agg(*aggs)
    framed = agg.select(spec.over_window("window").alias("window"), *keys, "n", *extra)
    return _grouped(framed, keys, aggs, window_totals)


def hierarchy(df: DataFrame, specs: Sequence[WindowSpec], keys: Sequence[str] = (),
              time_col: str = "create_ts", with_entry: bool = False,
              chained: bool = True, window_totals: bool = False) -> dict[str, DataFrame]:
    """Counts for every spec.  ``chained`` feeds each level from the previous
    one (finest first); otherwise each level is counted from the raw rows.
    ``window_totals`` adds the per-window total rows to every *returned*
    level (the chain itself is fed from the keyed rows only)."""
    out: dict[str, DataFrame] = {}
    prev = None
    for spec in specs:
        if prev is None or not chained:
            cur = count_by(df, spec, keys, time_col, with_entry)
            shown = count_by(df, spec, keys, time_col, with_entry, window_totals) if window_totals else cur
        else:
            cur = rollup(prev, spec, keys)
            shown = rollup(prev, spec, keys, window_totals) if window_totals else cur
        out[spec.name] = shown
        prev = cur
    return out


def flatten(agg: DataFrame) -> DataFrame:
    """Replace the window struct by ``window_start`` (TIMESTAMP_NTZ, UTC)."""
    rest = [c for c in agg.columns if c != "window"]
    return agg.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), *rest)
