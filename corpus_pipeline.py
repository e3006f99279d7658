"""From raw documents to a training mixture, one stage after another.

Each stage reads what its predecessor kept, as written in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontam, langid, linededup, mixing, neardup
from tallyhouse.llm.queries import table
from tallyhouse.session import pin_runtime
from tallyhouse.workspace import stage

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def pinned(step: Step) -> Step:
    """The step under the settings this package relies on."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return step(pin_runtime(spark), docs, sf_dir)

    return run_step


@pinned
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language that can be told."""
    return langid.identified_only(docs)


@pinned
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    return linededup.without_repeated_lines(docs)


@pinned
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.one_of_each_group(docs)


@pinned
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


@pinned
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their tokens, domain posteriors and sampling rate."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("mixture", mixture),
]

# Trained classifiers and fitted rates are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
