"""Occurrences of a given set of word grams in every document, by one Spark join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_WORD, ascii_lower, row_identity, small_side, text_of, words_of

#: Rows of the gram table that may be broadcast (about 100 bytes each).
MAX_BROADCAST_GRAMS = 1_000_000


def lower_words(c: Column) -> Column:
    return words_of(ascii_lower(c), NOT_WORD)


def grams(words: str, size: int, pos: str) -> str:
    """SQL: all rolling grams of ``size`` words, as structs of position and words joined by blanks."""
    joined = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return (f"if(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), "
            f"i -> struct(i as {pos}, concat_ws(' ', {joined}) as gram)), "
            f"cast(array() as array<struct<{pos}: int, gram: string>>))")


def hashed_grams(words: str, size: int) -> str:
    """SQL: all rolling grams of ``size`` words, as structs of position and a
    64-bit hash, from an array of the words' own hashes."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(size))
    return (f"if(size({words}) >= {size}, transform(sequence(0, size({words}) - {size}), "
            f"i -> struct(i as pos, xxhash64({parts}) as gram)), "
            f"cast(array() as array<struct<pos: int, gram: bigint>>))")


def gram_sizes(wanted: DataFrame) -> list[int]:
    """Distinct word counts of the wanted grams (the caller bounds them by its gram size)."""
    return sorted(r[0] for r in wanted.select(F.size(F.split("gram", " "))).distinct().collect())


def hash_of_gram(gram: str, sizes: list[int]) -> Column:
    """The hash that ``hashed_grams`` gives a gram written as words joined by blanks."""
    w = f"transform(split({gram}, ' '), w -> xxhash64(w))"
    cases = " ".join(f"when {n} then {hashed_grams(w, n)}[0].gram" for n in sizes)
    return F.expr(f"case size(split({gram}, ' ')) {cases} end") if sizes else F.lit(0).cast("bigint")


def hashed_occurrences(docs: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """``gram_occurrences`` with ``gram`` as ``hash_of_gram`` on both sides."""
    with_mark = wanted.select("gram").union(docs.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("gram")))
    mark = "array(struct(-1 as pos, 0L as gram))"
    every = ", ".join([mark, *(hashed_grams("words", n) for n in sizes)])
    return (docs.select(*row_identity(), lower_words(text_of()).alias("words"))
            .select("doc_id", "text_key", F.expr("transform(words, w -> xxhash64(w))").alias("words"))
            .select("doc_id", "text_key", F.size("words").alias("n_words"), F.explode(F.expr(f"concat({every})")).alias("g"))
            .select("doc_id", "text_key", "n_words", "g.pos", "g.gram")
            .join(small_side(with_mark, MAX_BROADCAST_GRAMS), "gram"))


def gram_occurrences(docs: DataFrame, wanted: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows ``(doc_id, text_key, n_words, pos, gram)``: every place where a gram
    of ``wanted(gram)`` stands in a document, and one row with ``pos = -1`` and
    an empty gram for each document row, so that one pass over the texts also
    counts the words.  ``wanted`` must hold distinct grams."""
    spark = docs.sparkSession
    with_mark = wanted.select("gram").union(spark.range(1).select(F.lit("").alias("gram")))
    mark = "array(struct(-1 as pos, '' as gram))"
    every = ", ".join([mark, *(grams("words", n, "pos") for n in sizes)])
    return (docs.select(*row_identity(), lower_words(text_of()).alias("words"))
            .select("doc_id", "text_key", F.size("words").alias("n_words"), F.explode(F.expr(f"concat({every})")).alias("g"))
            .select("doc_id", "text_key", "n_words", "g.pos", "g.gram")
            .join(small_side(with_mark, MAX_BROADCAST_GRAMS), "gram"))
