"""A corpus pipeline: language, exact copies, near copies, benchmark passages, subword encoding.

Each stage takes (spark, docs, sf_dir) and gives the documents that stay, with all
their columns; the last gives the encoded documents. Between stages the documents
are a written table, so a stage that is lost starts again from there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.llm.common import materialise, table
from tideline.llm.decontamination import decontaminated
from tideline.llm.exact_dedup import deduplicated
from tideline.llm.jaccard_join import one_of_each_class
from tideline.llm.language_id import with_known_language
from tideline.llm.merge_dropout import codec_report

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts without letters go."""
    return with_known_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal without white space."""
    return deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of texts that are joined by a similarity of 0.8 or more."""
    return one_of_each_class(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document: the digest of its token ids and of the text decoded from them."""
    return codec_report(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark_passages),
    ("merge_dropout", encoded),
]

#: Language profiles and keyed merges can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
