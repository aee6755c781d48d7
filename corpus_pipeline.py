"""From raw documents to packed training sequences, in stages that each rest on one operator.

Every stage works on the rows that the one before has kept, with all columns of
``documents``; only the last returns something else, the pieces and their places.
``run`` stores the result of every stage as Parquet in the shared folder and reads it
back, so a stage starts from files that outlive any executor.

What a stage returns is read from tables that it has stored on its way. They are
removed when the next stage begins, as its rows are stored by then; so the disk holds the
intermediate tables of one stage, and a result is valid until the next stage begins.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm import chunks, jaccard, lines, packing, quality
from gaugeworks.llm.common import table
from gaugeworks.sources.shared import materialise, recorded_intermediates, remove_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Per application, the tables that the last stage has left behind.
_LEFT: dict[str, list[str]] = {}


def tidy(function: Stage) -> Stage:
    """A stage that removes the intermediate tables of the one before it."""

    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        for folder in _LEFT.pop(application, []):
            remove_folder(spark, folder)
        with recorded_intermediates() as made:
            result = function(spark, docs, sf_dir)
        _LEFT[application] = made
        return result

    return stage


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed votes of the rules call good."""
    return quality.good_documents(docs)


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that are spread over many sites."""
    return lines.remove_spread_lines(docs)


@tidy
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return jaccard.keep_one(docs)


@tidy
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, passages that others have too left at their first place only."""
    return chunks.remove_repeats(docs)


@tidy
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Estimating rule accuracies, connected components and packing are iterative.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
