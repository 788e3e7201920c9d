"""Joins whose left side may have a key with a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, max_hot: int = 1_000) -> DataFrame:
    """The ``max_hot`` most frequent keys of ``df``.

    Counting is pre-aggregated in every task and reads only the key column.  No
    key outside the result can hold more than one ``max_hot``-th of the rows.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), key).limit(max_hot).select(key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    hot: DataFrame,
    how: str = "left",
    salts: int = 256,
) -> DataFrame:
    """Equi-join on ``key`` with the hot keys of the left side spread over ``salts`` tasks.

    ``hot`` holds at most a few thousand keys and is broadcast.  Only the right
    rows of hot keys are repeated.  Null keys of the left side, which match
    nothing, are spread as well.
    """
    listed = F.broadcast(hot.select(key).distinct().withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(F.col(spread_by)), F.lit(salts)).cast("int")
    salted_left = (
        left.join(listed, key, "left")
        .withColumn(
            "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
        )
        .drop("_hot")
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = (
        right.join(listed, key, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
