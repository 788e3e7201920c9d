"""Preview, statistics and distribution tables of the ranked pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine.operators.quantiles import exact_quantiles

MEASURES = [
    "start_confidence", "end_confidence", "average_confidence", "span_confidence", "clip_score",
]
CONFIDENCES = MEASURES[:4]
_QUARTILES = [0.25, 0.5, 0.75]


def preview(results: DataFrame, rows: int = 5, text_chars: int = 50) -> DataFrame:
    """The first ranked pairs, score with four decimals, text cut."""
    return (
        results.orderBy(F.col("clip_score").desc_nulls_last(), "prediction_id")
        .limit(rows)
        .select(
            "image_url",
            F.format_string("%.4f", "clip_score").alias("clip_score"),
            F.concat(F.substring("predicted_text", 1, text_chars), F.lit("...")).alias("description"),
        )
    )


def long_measures(results: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """``(measure, value)``: one row per result and measure."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    )
    return results.select(F.inline(pairs)).filter(F.col("value").isNotNull())


def summary(results: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """One row per measure: count, mean, standard deviation, extremes and exact quartiles."""
    long = long_measures(results, measures)
    moments = long.groupBy("measure").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return moments.join(_quartiles(long), "measure")


def _quartiles(long: DataFrame) -> DataFrame:
    found = exact_quantiles(long, "measure", "value", _QUARTILES)
    at = lambda q, name: F.max(F.when(F.col("probability") == q, F.col("value"))).alias(name)
    return found.groupBy("measure").agg(at(0.25, "q1"), at(0.5, "median"), at(0.75, "q3"))


def correlation(results: DataFrame) -> DataFrame:
    """Pearson correlation of each confidence with the score; null where one is constant."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in CONFIDENCES]
    )
    long = results.select("clip_score", F.inline(pairs))
    both = long.filter(F.col("value").isNotNull() & F.col("clip_score").isNotNull())
    spread = F.stddev_pop("value") * F.stddev_pop("clip_score")
    pearson = F.try_divide(F.covar_pop("value", "clip_score"), spread)
    return both.groupBy("measure").agg(pearson.alias("pearson"))


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin number from 0; the upper edge belongs to the last bin.

    Values below ``low`` have bin -1, those above ``high`` bin ``bins``.
    """
    step = (high - low) / bins
    inside = F.least(F.lit(bins - 1), F.floor((value - F.lit(low)) / F.lit(step)))
    return F.when(value < low, -1).when(value > high, bins).otherwise(inside).cast("int")


def histogram(
    results: DataFrame, measure: str = "clip_score", low: float = -1.0, high: float = 1.0, bins: int = 20
) -> DataFrame:
    """``(bin, n)`` of the occupied bins."""
    values = results.filter(F.col(measure).isNotNull())
    return values.groupBy(_bin(F.col(measure), low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def boxplot(results: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and outlier count."""
    long = long_measures(results, measures)
    quartiles = _quartiles(long)
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - spread, F.col("q3") + spread
    inside = F.col("value").between(low, high)
    return (
        long.join(F.broadcast(quartiles), "measure")  # one row per measure
        .groupBy("measure", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def heatmap(
    results: DataFrame, confidence: str = "span_confidence", bins: int = 10
) -> DataFrame:
    """``(confidence_bin, score_bin, n)`` of the occupied cells."""
    values = results.filter(F.col(confidence).isNotNull() & F.col("clip_score").isNotNull())
    return values.groupBy(
        _bin(F.col(confidence), 0.0, 1.0, bins).alias("confidence_bin"),
        _bin(F.col("clip_score"), -1.0, 1.0, bins).alias("score_bin"),
    ).agg(F.count(F.lit(1)).alias("n"))
