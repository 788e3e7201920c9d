"""Exact quantiles per group without collecting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmine.session import scratch

#: A band of at most this many different values is ranked.
BAND_VALUES = 100_000
_ACCURACY = 20_000
_BAND = 5.0 / _ACCURACY
#: Bins a wider band is counted in; a few rounds tell any two doubles apart.
_BINS = 4_096
_ROUNDS = 8


def exact_quantiles(
    df: DataFrame, group: str, value: str, probabilities: list[float]
) -> DataFrame:
    """``(group, probability, value)`` with linear interpolation between neighbours.

    A bounded sketch per group gives, for each probability, two values that
    surely enclose the wanted ranks.  What lies outside that band is only
    counted; inside it, one row in two thousand, equal values are pre-aggregated
    and then ranked.  A band that could hold more than ``BAND_VALUES`` different values is
    first counted in bins and narrowed to those of the wanted ranks, again and again, so
    the ranked rows stay bounded however many rows a group has.  The result is exact.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        F.col(group), F.col(value).cast("double").alias("_v")
    )
    edges = [p for q in probabilities for p in (max(q - _BAND, 0.0), min(q + _BAND, 1.0))]
    sketch = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", edges, _ACCURACY).alias("_edges"),
    )
    targets = sketch.select(
        group,
        "_n",
        F.posexplode(F.array(*[F.lit(float(q)) for q in probabilities])).alias("_i", "_q"),
        F.col("_edges"),
    ).select(
        group,
        "_q",
        ((F.col("_n") - 1) * F.col("_q")).alias("_rank"),
        F.get("_edges", 2 * F.col("_i")).alias("_low"),
        F.get("_edges", 2 * F.col("_i") + 1).alias("_high"),
    )
    most = sketch.agg(F.max("_n")).first()[0] or 0
    if 4 * _BAND * most <= BAND_VALUES:
        return _ranked(rows, targets, group)
    spark = df.sparkSession
    with scratch(spark, "quantile-bands") as folder:
        for number in range(_ROUNDS):
            _narrowed(rows, targets, group).write.parquet(f"{folder}/{number}")
            targets = spark.read.parquet(f"{folder}/{number}")
            if targets.filter((F.col("_held") > BAND_VALUES) & (F.col("_low") < F.col("_high"))).isEmpty():
                break
        bands = [tuple(r) for r in targets.drop("_held").collect()]  # one row per group and probability
        schema = targets.drop("_held").schema
    return _ranked(rows, spark.createDataFrame(bands, schema), group)


def _narrowed(rows: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    """``targets`` with the band cut down to the bins that hold the wanted ranks, and ``_held``, its rows."""
    value, low, high = F.col("_v"), F.col("_low"), F.col("_high")
    inside = F.least(F.floor((value - low) / (high - low) * _BINS), F.lit(_BINS - 1)) + 1
    place = (
        F.when(value < low, 0).when(value > high, _BINS + 1).when(low == high, 1).otherwise(F.coalesce(inside, F.lit(1)))
    )
    placed = rows.join(F.broadcast(targets), group).select(group, "_q", "_rank", place.alias("_bin"), "_v")
    counted = placed.groupBy(group, "_q", "_rank", "_bin").agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    running = Window.partitionBy(group, "_q").orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.sum("_c").over(running))

    def holds(rank):
        return (F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto"))

    first, last = holds(F.floor("_rank")), holds(F.ceil("_rank"))
    # Of what lies outside the band, the neighbour of the band is wanted.
    start = F.when(F.col("_bin") == 0, F.col("_max")).otherwise(F.col("_min"))
    end = F.when(F.col("_bin") == _BINS + 1, F.col("_min")).otherwise(F.col("_max"))
    return ranked.groupBy(group, "_q", "_rank").agg(
        F.min(F.when(first, start)).alias("_low"),
        F.max(F.when(last, end)).alias("_high"),
        F.sum(F.when(first | last, F.col("_c")).otherwise(0)).alias("_held"),
    )


def _ranked(rows: DataFrame, targets: DataFrame, group: str) -> DataFrame:
    """The values at the wanted ranks, from bands that enclose them."""
    # One row per group and probability, so the broadcast is as small as the
    # list of groups: kinds of measures, never a data key.
    placed = rows.join(F.broadcast(targets), group).select(
        group,
        "_q",
        "_rank",
        F.when(F.col("_v") < F.col("_low"), 0)
        .when(F.col("_v") <= F.col("_high"), 1)
        .otherwise(2)
        .alias("_zone"),
        "_v",
    )
    band_value = F.when(F.col("_zone") == 1, F.col("_v")).alias("_at")
    counted = placed.groupBy(group, "_q", "_rank", "_zone", band_value).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    running = (
        Window.partitionBy(group, "_q")
        .orderBy("_zone", "_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counted.withColumn("_upto", F.sum("_c").over(running))
    first = F.col("_upto") - F.col("_c")

    def value_at(rank):
        # Outside the band only the neighbours of the band are known, which is
        # all an interpolation at its edge can ask for.
        return F.max(
            F.when((F.col("_zone") == 1) & (first <= rank) & (rank < F.col("_upto")), F.col("_at"))
            .when((F.col("_zone") == 0) & (rank == F.col("_upto") - 1), F.col("_max"))
            .when((F.col("_zone") == 2) & (rank == first), F.col("_min"))
        )

    ends = ranked.groupBy(group, "_q", "_rank").agg(
        value_at(F.floor("_rank")).alias("_a"), value_at(F.ceil("_rank")).alias("_b")
    )
    fraction = F.col("_rank") - F.floor("_rank")
    return ends.select(
        group,
        F.col("_q").alias("probability"),
        (F.col("_a") + (F.col("_b") - F.col("_a")) * fraction).alias("value"),
    )
