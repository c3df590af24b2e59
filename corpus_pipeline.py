"""A corpus pipeline of five stages; each works on all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs.  All but the last
return the columns of ``documents``.  The last returns ``doc_id, start,
n_tokens, ids_crc32`` as read back from the binary files it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from windtally.llm import byte_cnn, mixing, prefix_decontam, simhash_bits, token_files
from windtally.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language (operator 10).

    Null texts and texts without a letter have none and go, as do all rows if
    no row has a lang to learn from; each repeated row is judged; no rows give no rows."""
    return byte_cnn.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (operator 4), see ``simhash_bits.keep_one``.

    Texts without words are one group; rows without doc_id all stay; no rows
    give no rows."""
    return simhash_bits.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item (operator 5).

    Null and empty texts hold none and stay; rows that repeat an id are judged
    by their own texts; without benchmark items all rows stay."""
    return prefix_decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out as their rates say (operator 2).

    A row is taken as often as the whole part of its rate says, and once more by a
    draw from its id and number of words, alike for rows that share both;
    no rows give no rows."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary files, and what they hold (operator 9).

    A null or empty text is one end id; repeated rows are documents of their
    own; no rows give no files and no rows."""
    return token_files.encode_corpus(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: No stage but the third can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
