"""Asset admission, image-text similarity and the outcome of each prediction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmine import settings
from pairmine.functions import urls, vectors
from pairmine.operators.skew import hot_keys, salted_join
from pairmine.operators.store import surrogate_key


def asset_reject_reason(
    min_bytes: int = settings.MIN_IMAGE_BYTES,
    min_width: int = settings.MIN_IMAGE_WIDTH,
    min_height: int = settings.MIN_IMAGE_HEIGHT,
) -> Column:
    """Why the image of a row is not usable; null when it is.

    A length that was not declared counts as zero.
    """
    return (
        F.when(~urls.is_fetchable(F.col("image_url")), "invalid_url")
        .when(~F.coalesce(F.col("http_ok"), F.lit(False)), "http_error")
        .when(F.coalesce(F.col("declared_length"), F.lit(0)) < min_bytes, "too_small")
        .when(~F.coalesce(F.col("decodable"), F.lit(False)), "undecodable")
        .when(
            (F.coalesce(F.col("width"), F.lit(0)) < min_width)
            | (F.coalesce(F.col("height"), F.lit(0)) < min_height),
            "low_resolution",
        )
    )


def admit_assets(
    pending: DataFrame,
    assets: DataFrame,
    hot_urls: DataFrame | None = None,
    spread_by: str = "prediction_id",
    **limits,
) -> DataFrame:
    """Pending rows with their asset, ``reject_reason`` and ``image_local_path``.

    ``assets`` has one row per ``image_url``.  One image, a logo say, may belong
    to a large share of all predictions: such URLs (``hot_urls``, counted here
    unless given) are spread over many tasks.
    """
    hot = hot_keys(pending, "image_url") if hot_urls is None else hot_urls
    joined = salted_join(pending, assets, "image_url", spread_by=spread_by, hot=hot, how="left")
    judged = joined.withColumn("reject_reason", asset_reject_reason(**limits))
    return judged.withColumn(
        "image_local_path",
        F.when(F.col("reject_reason").isNull(), urls.asset_name("image_url")),
    )


def embed(make_encoder: Callable, *columns: str, batch_size: int = settings.PREDICTION_BATCH) -> Column:
    """Embedding column of the user's encoder: arrays in, a (batch, dimension) array out."""
    encoder = predict_batch_udf(
        make_encoder, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size
    )
    return encoder(*columns)


def pair_similarity(text: Column, image_embedding: Column, text_embedding: Column) -> Column:
    """Similarity of an image and its description; null without text or embeddings."""
    return F.when(
        F.coalesce(text, F.lit("")) != "", vectors.cosine(image_embedding, text_embedding)
    )


def error_message() -> Column:
    """Error text of a judged row: asset failures first, then a missing score."""
    return F.when(F.col("reject_reason").isNotNull(), settings.ERROR_DOWNLOAD).when(
        F.col("clip_score").isNull(), settings.ERROR_SCORING
    )


def score_admitted(admitted: DataFrame) -> DataFrame:
    """Adds ``clip_score`` (null for a rejected asset) and ``error_message``."""
    score = F.when(
        F.col("reject_reason").isNull(),
        pair_similarity(F.col("predicted_text"), F.col("image_embedding"), F.col("text_embedding")),
    )
    return admitted.withColumn("clip_score", score).withColumn("error_message", error_message())


def to_result_rows(
    scored: DataFrame, version: Column, model_name: str = settings.SIMILARITY_MODEL
) -> DataFrame:
    """Outcomes as result table rows."""
    return scored.select(
        surrogate_key("prediction_id").alias("clip_result_id"),
        "prediction_id",
        "image_local_path",
        "clip_score",
        F.lit(model_name).alias("clip_model_name"),
        F.current_timestamp().alias("enrichment_timestamp"),
        "error_message",
        version.cast("bigint").alias("version"),
    )


def enrichment_counters(results: DataFrame) -> DataFrame:
    """One row: processed, scored, download failures, scoring failures."""
    message = F.col("error_message")
    return results.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(message.isNull()).alias("scored"),
        F.count_if(message.startswith("Download")).alias("failed_download"),
        F.count_if(message.startswith("CLIP")).alias("failed_scoring"),
    )
