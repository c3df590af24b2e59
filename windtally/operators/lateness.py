"""Exact per-record lateness of a punctuated, zero-delay watermark.

Every record moves the watermark of its source partition to its own event time,
never back; the stream's watermark is the least over all source partitions and
does not exist before each of them has delivered.  A record is late if its
window had closed when it arrived: the last millisecond of the window is not
after the watermark that all *earlier* arrivals had set.

In a table of arrivals this is a prefix maximum per source partition over the
arrival order.  Arrivals are dealt into ranges of that order; a range knows its
own running maxima, gets the maxima of all ranges before it carried forward
(one row for each range and source partition), and takes the minimum over the sources.  No
window spans more than one range, whatever the number of arrivals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windtally.functions.timewin import WindowSpec
from windtally.session import checkpoint_root, stored


def watermark_before(arrivals: DataFrame, source: str, order: list[str], event_ms: Column, ranges: int | None = None) -> DataFrame:
    """Adds ``watermark_ms``: the watermark a record meets, null before all sources have delivered.

    ``source``: column with the source partition; there are as many as the
    topic has (one expression each).  ``order``: columns that order all
    arrivals, without ties.  ``ranges``: default the session's shuffle partitions.
    Records without an event time move nothing and are never late.
    """
    spark = arrivals.sparkSession
    checkpoint_root(spark)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = arrivals.columns
    dealt = stored(arrivals.withColumn("_ms", event_ms).repartitionByRange(n, *order)
                   .withColumn("_range", F.spark_partition_id()), "arrivals")
    sources = [r[0] for r in dealt.select(source).distinct().orderBy(F.asc_nulls_first(source)).collect()]
    number = F.lit(None).cast("int")
    for i, s in enumerate(sources):
        number = F.when(F.col(source).eqNullSafe(F.lit(s)), i).otherwise(number)
    own = dealt.select("_range", number.alias("_source"), "_ms").groupBy("_range", "_source").agg(F.max("_ms").alias("_top"))
    # every source has a row in every range, so that its maximum is carried through ranges without it
    grid = own.select("_source").distinct().withColumn("_range", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = (grid.join(own, ["_source", "_range"], "left").withColumn("_top", F.max("_top").over(earlier))
               .groupBy("_range").agg(*[F.max(F.when(F.col("_source") == i, F.col("_top"))).alias(f"_carry{i}") for i in range(len(sources))]
                                      or [F.lit(None).cast("long").alias("_carry")]))
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range: bounded by their number
    out = dealt.withColumn("_number", number).join(F.broadcast(carried.checkpoint(eager=True)), "_range")
    mark = F.lit(None).cast("long")
    if sources:
        tops = [F.greatest(F.col(f"_carry{i}"), F.max(F.when(F.col("_number") == i, F.col("_ms"))).over(before)) for i in range(len(sources))]
        out = out.select(*names, *[t.alias(f"_mark{i}") for i, t in enumerate(tops)])
        marks = [F.col(f"_mark{i}") for i in range(len(sources))]
        all_there = marks[0].isNotNull()
        for m in marks[1:]:
            all_there = all_there & m.isNotNull()
        mark = F.when(all_there, F.least(*marks) if len(marks) > 1 else marks[0])
    return out.select(*names, mark.alias("watermark_ms"))


def late_verdicts(arrivals: DataFrame, spec: WindowSpec, source: str, order: list[str], time_col: str = "create_ts",
                  ranges: int | None = None) -> DataFrame:
    """``watermark_before`` plus ``is_late``: the record's ``spec`` window had closed before it arrived."""
    marked = watermark_before(arrivals, source, order, F.unix_millis(time_col), ranges)
    return marked.withColumn("is_late", F.coalesce(F.col("watermark_ms") >= spec.end_ms(time_col) - 1, F.lit(False)))
