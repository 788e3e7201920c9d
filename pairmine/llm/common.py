"""Small helpers that several operators of this package share."""

from __future__ import annotations

import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine.session import ship

#: A word of the text contracts: a run without ASCII white space.
WHITE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ship_code(spark: SparkSession) -> None:
    """Hand the package to the Python workers."""
    ship(spark, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def words(text: Column) -> Column:
    """Words without ASCII white space between them; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), WHITE, " " * len(WHITE))
    return F.filter(F.split(spaced, " "), lambda w: w != F.lit(""))


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions so that each gets about ``rows_each`` rows; one per core at least."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / max(1, rows_each)))
