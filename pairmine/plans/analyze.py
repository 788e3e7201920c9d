"""Stored results to report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairmine.operators import report, store
from pairmine.plans.enrich import current_results
from pairmine.sources import tables


def ranked_pairs(
    spark: SparkSession, root: str, min_score: float | None = None, limit: int | None = None
) -> DataFrame:
    """The final ranked pairs of a store."""
    return store.final_results(
        tables.read_table(spark, root, "predicted_descriptions"),
        tables.read_table(spark, root, "image_context"),
        current_results(spark, root),
        min_score,
        limit,
    )


def write_report(
    spark: SparkSession, root: str, output: str, min_score: float | None = None, limit: int | None = None
) -> dict[str, str]:
    """Write the ranked pairs and every statistics table as Parquet; returns their paths.

    The statistics read the written pairs, so the joins run once.
    """
    base = output.rstrip("/")
    paths = {"pairs": f"{base}/pairs"}
    ranked_pairs(spark, root, min_score, limit).write.mode("overwrite").parquet(paths["pairs"])
    pairs = spark.read.parquet(paths["pairs"])
    reports = {
        "preview": report.preview(pairs),
        "summary": report.summary(pairs),
        "correlation": report.correlation(pairs),
        "histogram": report.histogram(pairs),
        "boxplot": report.boxplot(pairs),
        "heatmap": report.heatmap(pairs),
    }
    for name, table in reports.items():
        paths[name] = f"{base}/{name}"
        table.write.mode("overwrite").parquet(paths[name])
    return paths
