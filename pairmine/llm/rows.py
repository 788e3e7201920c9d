"""Joins of whole documents with small facts about some of them."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine.session import stage

#: Rows of at most two numbers that are sent to every executor; above, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def sized(facts: DataFrame, name: str, items: str | None = None) -> DataFrame:
    """The facts, written once; marked for broadcast if they are counted as few.

    With ``items``, an array, its elements are counted instead of the rows.
    """
    held = stage(facts, name)
    few = held.count() if items is None else held.agg(F.sum(F.size(items))).first()[0] or 0
    return F.broadcast(held) if few <= BROADCAST_ROWS else held.hint("merge")


def drop_rows(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone``."""
    return docs.join(sized(gone, "gone"), key, "left_anti")


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps.

    Spark removes them when the driver collects the plans they belong to, which a
    driver with free memory may put off for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
