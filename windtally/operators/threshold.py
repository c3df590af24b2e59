"""Exact top-N of a coarse window from its finer windows without summing every key.

A coarse window is the union of ``parts`` fine ones.  (1) The top-N of every
fine window are summed up; the N-th largest of these partial sums is a lower
bound of the N-th largest total.  (2) A key whose total reaches the bound
reaches ``bound / parts`` in at least one fine window: only such keys are
candidates.  (3) The candidates' fine rows are summed exactly and ranked.

Ties are kept by comparing with "at least", so keys that tie with the last
place stay candidates.  What crosses the coarse shuffle is the candidates' rows
in place of all (window, key) rows; where counts are even, most keys are
candidates and nothing is saved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windtally.functions.timewin import WindowSpec
from windtally.operators.ranking import TOP_N, top_n
from windtally.session import stored


#: Joined sides of at most this many bytes, as counted, are broadcast.
BROADCAST_BYTES = 32 << 20


def counted_side(df: DataFrame, key: str | None = None) -> DataFrame:
    """Store ``df`` (a time, a count and perhaps a ``key``) and broadcast it if its counted bytes allow it."""
    df = stored(df, "side")
    width = F.lit(48) + (F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0)) if key else F.lit(0))
    size = df.select(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def candidates(fine: DataFrame, spec: WindowSpec, parts: int, n: int = TOP_N, key: str = "article_id") -> DataFrame:
    """``coarse, key`` of all keys that can be in the top ``n`` of their ``spec`` window.

    ``fine``: ``window_start`` (timestamp), ``coarse`` (start of its ``spec`` window), key, n."""
    local = top_n(fine.select("window_start", key, "n"), n, key).withColumn("coarse", spec.over("window_start")["start"])
    partial = local.groupBy("coarse", key).agg(F.sum("n").alias("n"))
    place = Window.partitionBy("coarse").orderBy(F.col("n").desc(), F.col(key).asc())
    bound = partial.withColumn("place", F.row_number().over(place)).where(F.col("place") == n).select("coarse", F.col("n").alias("bound"))
    # a window with fewer partial sums than n has no bound: all its keys are candidates
    reach = fine.join(counted_side(bound), "coarse", "left").where(F.col("n") * parts >= F.coalesce("bound", F.lit(0)))
    return reach.select("coarse", key).distinct()


def threshold_top_n(fine: DataFrame, fine_spec: WindowSpec, spec: WindowSpec, n: int = TOP_N, key: str = "article_id") -> DataFrame:
    """``window_start, rnk, key, n`` of ``spec`` windows from counts per ``fine_spec`` window (``window, key, n``).

    ``fine`` is read three times; give a stored table.  It must hold one row for each (window, key)."""
    rows = fine.select(F.col("window.start").alias("window_start"), spec.over_window("window")["start"].alias("coarse"), key, "n")
    # a null key may be one of the top
    chosen = counted_side(candidates(rows, spec, spec.seconds // fine_spec.seconds, n, key).withColumnsRenamed({"coarse": "_coarse", key: "_key"}), "_key")
    same = (F.col("coarse") == F.col("_coarse")) & F.col(key).eqNullSafe(F.col("_key"))
    exact = rows.join(chosen, same, "left_semi").groupBy("coarse", key).agg(F.sum("n").alias("n"))
    return top_n(exact.select(F.col("coarse").cast("timestamp_ntz").alias("window_start"), key, "n"), n, key)
