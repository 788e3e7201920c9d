"""Batched span prediction and the decoding of its logits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmine import settings
from pairmine.functions import sequences, spans
from pairmine.operators.skew import hot_keys, salted_join
from pairmine.operators.vocabulary import SPECIAL_TOKENS

LOGITS = T.StructType(
    [
        T.StructField("start_logits", T.ArrayType(T.FloatType())),
        T.StructField("end_logits", T.ArrayType(T.FloatType())),
    ]
)


def predict_logits(
    inputs: DataFrame,
    make_predict_fn: Callable,
    max_len: int = settings.MAX_LEN,
    batch_size: int = settings.PREDICTION_BATCH,
) -> DataFrame:
    """Adds ``start_logits`` and ``end_logits`` to padded inputs.

    ``make_predict_fn`` runs once per Python worker and returns a function from
    the arrays ``input_ids`` and ``attention_mask`` (batch by max_len) to a dict
    of the two logit arrays.  Any user model plugs in here.
    """
    predict = predict_batch_udf(
        make_predict_fn,
        return_type=LOGITS,
        batch_size=batch_size,
        input_tensor_shapes=[[max_len], [max_len]],
    )
    return (
        inputs.withColumn("_logits", predict("input_ids", "attention_mask"))
        .select(*inputs.columns, "_logits.start_logits", "_logits.end_logits")
    )


def best_positions(logits: DataFrame) -> DataFrame:
    """Adds ``start_token`` and ``end_token``: the first maximum over all positions."""
    return logits.withColumns(
        {
            "start_token": spans.argmax(F.col("start_logits")),
            "end_token": spans.argmax(F.col("end_logits")),
        }
    )


def valid_spans(predicted: DataFrame) -> DataFrame:
    """Spans inside the unpadded sequence."""
    return predicted.filter(
        spans.is_valid_span(F.col("start_token"), F.col("end_token"), F.col("seq_len"))
    )


def with_confidences(predicted: DataFrame, method: str = "geometric") -> DataFrame:
    """Adds the four confidences of the chosen positions."""
    peaks = predicted.withColumns(
        {
            "start_confidence": spans.peak_probability(F.col("start_logits")),
            "end_confidence": spans.peak_probability(F.col("end_logits")),
        }
    )
    start, end = F.col("start_confidence"), F.col("end_confidence")
    return peaks.withColumns(
        {
            "average_confidence": (start + end) / 2.0,
            "span_confidence": spans.span_confidence(start, end, method),
        }
    )


def decode_spans(predicted: DataFrame) -> DataFrame:
    """Adds ``predicted_text`` from ``sequence_tokens``; drops spans without text.  Narrow."""
    decoded = predicted.withColumn(
        "predicted_text",
        spans.span_text(
            F.col("sequence_tokens"), F.col("start_token"), F.col("end_token"), list(SPECIAL_TOKENS)
        ),
    )
    return decoded.filter(F.col("predicted_text") != "")


def token_strings(
    predicted: DataFrame, key: str, vocabulary: DataFrame, vocabulary_rows: int | None = None
) -> DataFrame:
    """Adds ``sequence_tokens`` where only token ids are there: the strings of the span's ids.

    Positions outside the span stay empty, so no more than the span is looked
    up.  The vocabulary is broadcast only below ``BROADCAST_ROW_LIMIT`` rows; beyond, the
    most frequent ids of the spans are spread over many tasks.
    """
    lookup = vocabulary.select("token", "token_id")
    rows = vocabulary.count() if vocabulary_rows is None else vocabulary_rows
    width = F.col("end_token") - F.col("start_token") + 1
    span = sequences.head(F.slice("sequence", F.col("start_token") + 1, F.greatest(width, F.lit(0))), width)
    placed = predicted.select(key, F.posexplode(span).alias("pos", "token_id"))
    if rows <= settings.BROADCAST_ROW_LIMIT:
        found = placed.join(F.broadcast(lookup), "token_id")
    else:
        found = salted_join(placed, lookup, "token_id", key, hot_keys(placed, "token_id"), "inner")
    named = found.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("_entries")
    )
    named = named.select(key, F.col("_entries.token").alias("_words"))
    return (
        predicted.join(named, key, "left")
        .withColumn(
            "sequence_tokens",
            F.concat(
                F.array_repeat(F.lit("[PAD]"), F.col("start_token")),
                F.coalesce("_words", F.array().cast("array<string>")),
            ),
        )
        .drop("_words")
    )


def decode_predictions(logits: DataFrame, method: str = "geometric") -> DataFrame:
    """Logits to rated, readable spans.  The cheap span test runs before the softmax."""
    return with_confidences(decode_spans(valid_spans(best_positions(logits))), method)


def inference_counters(inputs: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: contexts attempted and predictions added."""
    attempted = inputs.agg(F.count(F.lit(1)).alias("attempted"))
    added = predictions.agg(F.count(F.lit(1)).alias("added"))
    return attempted.select("attempted", added.scalar().alias("added"))
