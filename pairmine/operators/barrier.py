"""Filters that stay where they are written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, column: str) -> DataFrame:
    """Drop the rows where a computed column is null.

    A plain filter would be pushed below the projections that compute the
    column, and each would be copied into it, once per use.  A filter on the
    output of a generator stays above it.
    """
    others = [c for c in df.columns if c != column]
    kept = df.select(*others, F.explode_outer(F.array(column)).alias(column))
    return kept.filter(F.col(column).isNotNull()).select(*df.columns)
