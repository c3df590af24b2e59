"""Shared helpers: text columns, stored intermediate tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windtally.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Separators of alphanumeric words: every ASCII character but 0-9 and a-z (after lower-casing).
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Separators of blank-delimited words.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure-ASCII texts take the faster built-in ``lower``."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def words_of(c: Column, separators: str) -> Column:
    """Words between runs of separators, in order, without empty ones."""
    return F.array_remove(F.split(c, separators), "")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back:
    the lineage ends here and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = f"{scratch_path(spark, kind)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows (counted); beyond
    that the join is an ordinary shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def row_identity(id_col: str = "doc_id") -> list[Column]:
    """A document is (doc_id, text): repeated rows share one identity, rows
    that repeat an id with another text do not."""
    return [F.col(id_col).alias("doc_id"), F.xxhash64(text_of()).alias("text_key")]


def same_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on ``row_identity`` columns, null ids matching null ids; keeps the left ones."""
    r = right.withColumnsRenamed({"doc_id": "_r_id", "text_key": "_r_key"})
    on = left["doc_id"].eqNullSafe(r["_r_id"]) & (left["text_key"] == r["_r_key"])
    out = left.join(r, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop("_r_id", "_r_key")
