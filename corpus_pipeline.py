"""The corpus pipeline: documents to packed training sequences.

STAGES are applied in order; each takes what the one before it kept, written as
Parquet and read again.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import language_id, near_duplicates, packing, quality, substring_dedup
from gleaner.llm._spark import cut, table

#: The least score of a language that is believed, and of a text that is good.
LANGUAGE_SCORE, QUALITY_SCORE = 0.4, 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; a text without a letter, or of which no language has the score, goes.

    Null, empty and blank texts go, and all texts where no document has a language.  Rows
    that are equal, or have one id or none, are each judged by their text alone.  All columns
    stay; an empty table stays empty.
    """
    return language_id.keep_identified(docs, language_id.learn(docs), LANGUAGE_SCORE)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours are mostly good.

    A text that is like none of them, also a null or empty one, has the share of good
    documents among the labelled ones as its score, 0.5 if none is labelled; a score of 0.5
    stays.  Rows that are equal, or have one id or none, are each judged by their text
    alone.  All columns stay; an empty table stays empty.
    """
    return quality.keep_good(docs, quality.learn(docs, table(spark, sf_dir, "labels")), QUALITY_SCORE)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least id.

    Documents are told apart by id and text: different texts of one id are different
    documents; of rows equal in both, one stays.  A group without any id keeps one row.
    Null and blank texts are groups of their own.  All columns stay; an empty table stays
    empty.
    """
    return near_duplicates.one_of_each(docs)


def remove_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that a document with a smaller id has; n_chars is counted anew.

    A document of which nothing is left goes.  Null, empty and short texts stay as they
    are, and so do rows without an id.  Rows with one id do not take words from each other.
    All columns stay; an empty table stays empty.
    """
    return substring_dedup.kept_texts(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the training sequences.

    A null or empty text has one row without a bin.  Rows that are equal are packed as often as
    they come, each in a sequence of its own; a null source conflicts with nothing.  An
    empty table gives an empty result.
    """
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", join_near_duplicates),
    ("substring_dedup", remove_substrings),
    ("packing", pack_sequences),
]
#: No SQL expresses the classifiers; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
