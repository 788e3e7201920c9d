"""Pending predictions to stored results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.operators import enrichment, store
from pairmine.session import stage
from pairmine.sources import tables


def current_results(spark: SparkSession, root: str, without_batch: str | None = None) -> DataFrame:
    """One row per prediction: the latest write."""
    stored = tables.read_table(spark, root, "clip_results", without_batch)
    return store.latest_per_key(stored, "prediction_id", "version")


def current_predictions(
    spark: SparkSession, root: str, split_download_status: bool = False
) -> DataFrame:
    """Predictions with the status that follows from their current result."""
    predictions = tables.read_table(spark, root, "predicted_descriptions")
    return store.apply_status(predictions, current_results(spark, root), split_download_status)


def pending_pairs(open_rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """Pending predictions with their image, staged.

    Both the count of hot images and the join with the assets read them, and the
    size of a staged table is known to the planner.
    """
    return stage(store.pending_predictions(open_rows, contexts), "pending")


def outcomes(
    pending: DataFrame,
    assets: DataFrame,
    add_embeddings: Callable[[DataFrame], DataFrame],
    version: Column,
    model_name: str = settings.SIMILARITY_MODEL,
    **limits,
) -> DataFrame:
    """Result rows of pending predictions ``(prediction_id, predicted_text, image_url)``.

    ``add_embeddings`` adds ``image_embedding`` and ``text_embedding``, by a join
    or by the user's encoders.
    """
    admitted = enrichment.admit_assets(pending, assets, **limits)
    scored = enrichment.score_admitted(add_embeddings(admitted))
    return enrichment.to_result_rows(scored, version, model_name)


def enrich_from_store(
    spark: SparkSession,
    root: str,
    assets: DataFrame,
    add_embeddings: Callable[[DataFrame], DataFrame],
    batch: str,
    model_name: str = settings.SIMILARITY_MODEL,
    **limits,
) -> dict[str, int]:
    """Drain all predictions without a result; returns the counters of the run."""
    predictions = tables.read_table(spark, root, "predicted_descriptions")
    finished = tables.read_table(spark, root, "clip_results", without_batch=batch)
    open_rows = store.unprocessed(predictions, finished, "prediction_id")
    pending = pending_pairs(open_rows, tables.read_table(spark, root, "image_context"))
    counted = Observation("outcomes")
    message = F.col("error_message")
    rows = outcomes(
        pending, assets, add_embeddings, F.unix_micros(F.current_timestamp()), model_name, **limits
    ).observe(
        counted,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(message.isNull()).alias("scored"),
        F.count_if(message.startswith("Download")).alias("failed_download"),
        F.count_if(message.startswith("CLIP")).alias("failed_scoring"),
    )
    tables.write_batch(rows, root, "clip_results", batch)
    return dict(counted.get)
