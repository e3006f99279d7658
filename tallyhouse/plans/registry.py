"""The register of named queries."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ..functions.money import published
from ..session import pin_runtime
from ..sources.binding import Tables

# Reference day of recency, churn and lifetime figures: the newest order of the test tables.
AS_OF = date(2001, 8, 1)

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


def runnable(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query as a function of a session and a data folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return published(fn(Tables(pin_runtime(spark), str(sf_dir).rstrip("/"))))

    run.__name__ = fn.__name__
    return run


def stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
