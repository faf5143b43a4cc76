"""From raw documents to packed sequences: language, exact and near copies, mixing, packing.

Each stage takes all rows that the one before it kept and returns the columns of
``documents``; the last returns packed pieces. Every stage is written as Parquet in the
shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brasstally.llm.common import table, written
from brasstally.llm.exact_dedup import exact_dedup
from brasstally.llm.language_id import keep_identified
from brasstally.llm.mixing import mixed
from brasstally.llm.packing import pack
from brasstally.llm.simhash import simhash_dedup


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    return keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies by SimHash (three-word shingles, at most 2 bits apart), the smallest id."""
    return simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for: not at all, or up to three times."""
    return mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language scores, near copies and tokens are beyond SQL: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
