"""Example limits and the train/validation split."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmine import settings

_BUCKET_DIGITS = 4  # 65,536 buckets


def limit_examples(df: DataFrame, order: list[str], max_examples: int | None) -> DataFrame:
    """The first ``max_examples`` rows in the given order; all rows without a limit."""
    return df if max_examples is None else df.orderBy(*order).limit(max_examples)


def train_validation_split(
    df: DataFrame,
    key: str,
    validation_split: float = settings.VALIDATION_SPLIT,
    seed: int = 0,
) -> DataFrame:
    """Adds ``part``: ``train`` or ``validation``.

    Rows are shuffled by a seeded hash of their unique key.  Exactly
    ``int(n * (1 - validation_split))`` rows train, at least one and at most
    ``n - 1``; there is no validation part for a split of zero or a single row.

    No global sort: the sizes of 65,536 hash buckets show in which bucket the cut
    lies, only that bucket is ranked, and its hash at the cut splits the data
    with a plain comparison.
    """
    if validation_split <= 0:
        return df.withColumn("part", F.lit("train"))
    shuffle_hash = F.sha2(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))), 256)
    hashes = df.select(shuffle_hash.alias("h"))
    bucket = F.substring("h", 1, _BUCKET_DIGITS)
    sizes = hashes.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("size"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    summed = sizes.select(
        "bucket",
        "size",
        (F.sum("size").over(running) - F.col("size")).alias("before"),
        F.sum("size").over(whole).alias("total"),
    )
    wanted = F.floor(F.col("total") * F.lit(1.0 - validation_split))
    cut = F.greatest(F.lit(1), F.least(F.col("total") - 1, wanted))
    boundary = (
        summed.withColumn("cut", cut)
        .filter((F.col("before") < F.col("cut")) & (F.col("cut") <= F.col("before") + F.col("size")))
        .select("bucket", (F.col("cut") - F.col("before")).alias("rank"))
    )
    ranked = hashes.filter(bucket == boundary.select("bucket").scalar()).select(
        "h", F.row_number().over(Window.orderBy("h")).alias("position")
    )
    threshold = ranked.filter(F.col("position") == boundary.select("rank").scalar()).select("h")
    is_train = shuffle_hash <= threshold.scalar()
    return df.withColumn("part", F.when(is_train, F.lit("train")).otherwise(F.lit("validation")))
