"""The corpus pipeline: quality rules, language, near-duplicates, personal data, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``. Each stage's result is written before the next reads it. Nulls, empty texts, ties,
repeated rows and empty tables are as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import langid, nearcopies, packing, pii, rules
from tarmac.llm.common import table
from tarmac.llm.queries import WORD_VOCABULARY
from tarmac.operators.ranges import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found."""
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: Jaccard similarity 0.8 or more on five words."""
    return nearcopies.one_per_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with sanitised texts."""
    return pii.sanitise(docs)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in windows."""
    return packing.pack(docs, public_tokenizers.path(WORD_VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", windows),
]

ORACLE_SQL = None  # learned models, hashes and graph components have no SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result on ``documents``, each stage by way of a written table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
