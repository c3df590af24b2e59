"""Historical results kept up to date as input files arrive.

Under one folder::

    ledger/inc=<id>          the input files of an increment, written last
    <query>/base             first-level counts, partitioned by (day, inc)
    <query>/<window>         counts of a window size, partitioned by its start

``add`` takes the files that no committed increment has (path, length and time of change),
counts them alone into ``base``, and rolls up again only the windows that
hold one of their days, overwriting those partitions and leaving all other
files as they are.  Old days may arrive at any time.

An increment's id is made from its list of files and every write overwrites
its own partitions, so a rerun after a failure at any point gives the same
tables.  If more files have come meanwhile, the increment has another id and takes over the
failed one's files: rollups read committed increments and the current
one only, and whatever the failed one left is ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windtally.functions.timewin import DAY, HOUR, SPECS, WindowSpec
from windtally.operators.rollup import ENTRY, rollup
from windtally.plans.queries import article_counts, bucket_counts
from windtally.session import ensure_utc, path_exists

KEY = {"q1": "article_id", "q2": "bucket"}
WINDOWS = {"q1": ("1h", "24h", "7d"), "q2": ("24h", "7d", "30d")}
_LEDGER = "inc string, path string, length long, changed timestamp"


def _base_schema(query: str) -> str:
    return f"t timestamp, {KEY[query]} string, n long, {ENTRY} long, day date, inc string"


def _level_schema(query: str) -> str:
    return f"t timestamp, {KEY[query]} string, n long, {ENTRY} long, start string"


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Files of all committed increments."""
    if not path_exists(spark, f"{root}/ledger"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{root}/ledger")


def new_files(spark: SparkSession, folder: str, root: str, pattern: str = "*.parquet") -> list[tuple]:
    """``(path, length, changed)`` of the files no committed increment has.

    The list of one increment's files is on the driver, as it is for any read."""
    there = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
             .select("path", "length", F.col("modificationTime").alias("changed")))
    return sorted(map(tuple, there.join(ledger(spark, root), ["path", "length", "changed"], "left_anti").collect()))


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _first_level(comments: DataFrame, query: str) -> DataFrame:
    counts = article_counts(comments, latency=True)["1h"] if query == "q1" else bucket_counts(comments, latency=True)
    return counts.select(F.col("window.start").alias("t"), KEY[query], "n", ENTRY, F.to_date("window.start").alias("day"))


def _windows_of(days: list, spec: WindowSpec, spark: SparkSession) -> tuple[list, list]:
    """Starts of the ``spec`` windows that hold one of ``days``, and all days of these windows."""
    starts = (spark.createDataFrame([(d,) for d in days], "day date")
              .select(spec.over(F.col("day").cast("timestamp"))["start"].alias("s")).distinct())
    length = max(1, spec.seconds // DAY.seconds)
    every = starts.select(F.explode(F.sequence(F.to_date("s"), F.date_add(F.to_date("s"), length - 1))).alias("day")).distinct()
    return [r[0] for r in starts.collect()], [r[0] for r in every.collect()]


def add(spark: SparkSession, folder: str, root: str, read: Callable[[list[str]], DataFrame],
        queries: tuple[str, ...] = ("q1", "q2"), windows: tuple[str, ...] | None = None) -> dict | None:
    """Take in the new files of ``folder``; None if there are none.

    ``read`` turns a list of paths into valid typed comments.  Returns the
    increment's id, its number of files and the touched window starts by (query, window)."""
    ensure_utc(spark)
    files = new_files(spark, folder, root)
    if not files:
        return None
    inc = hashlib.sha256(repr([(p, n, str(t)) for p, n, t in files]).encode()).hexdigest()[:32]
    valid = [r[0] for r in ledger(spark, root).select("inc").distinct().collect()] + [inc]
    comments = read([f[0] for f in files])
    touched: dict[tuple[str, str], list] = {}
    for query in queries:
        base = f"{root}/{query}/base"
        _overwrite(_first_level(comments, query).withColumn("inc", F.lit(inc)), base, "day", "inc")
        counts = spark.read.schema(_base_schema(query)).parquet(base).where(F.col("inc").isin(valid))
        days = [r[0] for r in counts.where(F.col("inc") == inc).select("day").distinct().collect()]
        if not days:
            continue
        fine = HOUR if query == "q1" else SPECS["2h"]
        for name in windows or WINDOWS[query]:
            spec = SPECS[name]
            # hours are kept by day: their partitions are the touched days
            starts, every = _windows_of(days, spec if spec.seconds >= DAY.seconds else DAY, spark)
            rows = counts.where(F.col("day").isin(every)).withColumn("window", fine.over("t"))
            level = rollup(rows, spec, [KEY[query]]).select(F.col("window.start").alias("t"), KEY[query], "n", ENTRY)
            _overwrite(level.withColumn("start", F.date_format("t", "yyyy-MM-dd")), f"{root}/{query}/{name}", "start")
            touched[(query, name)] = starts
    # the increment counts from here on
    (spark.createDataFrame([(p, n, t) for p, n, t in files], "path string, length long, changed timestamp")
     .coalesce(1).write.mode("overwrite").parquet(f"{root}/ledger/inc={inc}"))
    return {"inc": inc, "files": len(files), "touched": touched}


def result(spark: SparkSession, root: str, query: str, window: str) -> DataFrame:
    """Flat counts of one window size: ``window_start, key, n, max_entry_time``."""
    return (spark.read.schema(_level_schema(query)).parquet(f"{root}/{query}/{window}")
            .select(F.col("t").cast("timestamp_ntz").alias("window_start"), KEY[query], "n", ENTRY))
