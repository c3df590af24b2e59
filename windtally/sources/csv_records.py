"""CSV records with line feeds inside quoted fields, read in parallel.

Spark's ``multiLine`` CSV option reads a whole file in one task.  Here a file is
read as physical lines, which Spark splits into byte blocks wherever it likes,
also inside a quoted field.  Whether a line begins inside quotes follows from the
number of quotes before it in its file: each chunk (``CHUNK_LINES`` lines of a
block at most) counts its own, the chunks' parities are summed up in file order
(one row a chunk), and inside a chunk a running sum does the rest.  The lines of
a record are joined where their chunk is; only records that cross the border of
a chunk or block are shuffled again.  So a task sorts and joins a share of the
lines that ``PIECES`` and the size of Spark's byte blocks bound, not a file or block.

Quoting is RFC 4180: a quote inside a quoted field is doubled, and there are no
quotes in unquoted fields.  Records end with LF or CRLF; a CRLF inside quotes is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windtally.session import checkpoint_root

#: Lines of a chunk, a power of two, and tasks that the chunks of one input split are dealt to.
CHUNK_LINES, PIECES = 1 << 12, 8


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, pos, line, quotes``: every line with its place in its byte block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"),
                        (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))).alias("quotes"))


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``value``: one row for each CSV record of the files, line feeds in quotes kept; without the first of each file if ``header``.

    The lines are shuffled once, by chunk; records across chunks once more."""
    checkpoint_root(spark)
    lines = physical_lines(spark, path)
    chunk = ["file", "block", "chunk"]
    lines = (lines.withColumn("chunk", F.floor(F.col("pos") / CHUNK_LINES))
             .repartition(max(1, PIECES * lines.rdd.getNumPartitions()), *chunk))
    # one row for each chunk: quotes before it in its file, and record starts before it if it began outside or inside quotes
    so_far = Window.partitionBy(*chunk).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = lines.withColumn("seen", F.sum("quotes").over(so_far) - F.col("quotes"))
    own = own.withColumns({"even": F.count_if(F.col("seen") % 2 == 0).over(so_far), "odd": F.count_if(F.col("seen") % 2 == 1).over(so_far)})
    sums = own.groupBy(*chunk).agg(F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"))
    earlier = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("carry", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    carried = carried.withColumn("starts", F.when(F.col("carry") == 0, F.col("even")).otherwise(F.col("odd")))
    carried = (carried.withColumn("first", F.coalesce(F.sum("starts").over(earlier), F.lit(0))).select(*chunk, "carry", "first")
               .checkpoint(eager=True))
    placed = own.join(carried, chunk).select(
        *chunk, "pos", "line", "quotes", ((F.col("seen") + F.col("carry")) % 2 == 0).alias("opens"),
        (F.col("first") + F.when(F.col("carry") == 0, F.col("even")).otherwise(F.col("odd"))).alias("record"))

    def joined(rows: DataFrame, by: list[str], *more) -> DataFrame:
        in_order = F.array_sort(F.collect_list(F.struct("block", "pos", "line")))
        return rows.groupBy(*by).agg(F.array_join(F.transform(in_order, lambda x: x["line"]), "\n").alias("line"), *more)

    # a chunk's lines of a record; all of them if the first opens it and the quotes are even
    parts = joined(placed, [*chunk, "record"], F.min("pos").alias("pos"),
                   (F.bool_or("opens") & (F.sum("quotes") % 2 == 0)).alias("whole"))
    rows = (parts.where("whole").select("record", "line")
            .unionByName(joined(parts.where("NOT whole"), ["file", "record"]).select("record", "line")))
    text = F.regexp_replace(F.col("line"), r"\r\z", "")
    if header:
        rows = rows.where("record > 1")
    return rows.where("line <> '' AND line <> '\\r'").select(text.alias("value"))
