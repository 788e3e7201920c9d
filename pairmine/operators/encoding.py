"""Token arrays to model sequences, for training and for inference.  All narrow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.functions import sequences
from pairmine.operators.vocabulary import CLS_ID, IMG_ID, PAD_ID, SEP_ID

SPECIALS = 3  # [CLS], [IMG] and [SEP]


def _ids(column: str) -> Column:
    return F.coalesce(F.col(column), F.array().cast("array<int>"))


def span_labels(before_length: Column, alt_length: Column) -> tuple[Column, Column]:
    """Start at the image mark; as many tokens long as the alt text."""
    start = before_length + 1
    return start, start + alt_length - 1


def encode_training(df: DataFrame, max_len: int = settings.MAX_LEN) -> DataFrame:
    """Encode ``(context_id, alt_text, before_ids, after_ids, alt_ids)``.

    The room left by the special tokens is halved: the first half keeps the end
    of the text before the image, the rest the beginning of the text after it;
    what one side leaves unused does not go to the other.  Adds ``sequence``
    (unpadded), ``seq_len``, ``true_start_token``, ``true_end_token`` and
    ``reject_reason`` (null for a usable example).
    """
    room = max(max_len - SPECIALS, 0)
    sides = df.select(
        "*",
        sequences.tail(_ids("before_ids"), F.lit(room // 2)).alias("_before"),
        sequences.head(_ids("after_ids"), F.lit(room - room // 2)).alias("_after"),
        F.size(_ids("alt_ids")).alias("_alt_len"),
    )
    start, end = span_labels(F.size("_before"), F.col("_alt_len"))
    encoded = sides.select(
        *df.columns,
        "_alt_len",
        sequences.assemble(F.col("_before"), F.col("_after"), CLS_ID, IMG_ID, SEP_ID).alias("sequence"),
        (F.size("_before") + F.size("_after") + SPECIALS).alias("seq_len"),
        start.alias("true_start_token"),
        end.alias("true_end_token"),
    )
    return encoded.withColumn("reject_reason", _reject_reason(max_len)).drop("_alt_len")


def _reject_reason(max_len: int) -> Column:
    return (
        F.when(F.coalesce(F.col("alt_text"), F.lit("")) == "", "empty_alt")
        .when(F.col("_alt_len") == 0, "alt_without_tokens")
        .when(F.col("_alt_len") > max_len - SPECIALS, "alt_too_long")
        .when(F.col("true_end_token") >= F.col("seq_len"), "span_outside_sequence")
        .when(F.col("seq_len") > max_len, "wrong_length")
    )


def pad_and_mask(encoded: DataFrame, max_len: int = settings.MAX_LEN) -> DataFrame:
    """Adds ``input_ids`` and ``attention_mask``, both ``max_len`` long."""
    return encoded.withColumns(
        {
            "input_ids": sequences.pad(F.col("sequence"), max_len, PAD_ID),
            "attention_mask": sequences.attention_mask(F.col("seq_len"), max_len),
        }
    )


def training_examples(df: DataFrame, max_len: int = settings.MAX_LEN) -> DataFrame:
    """Usable examples only, padded."""
    usable = encode_training(df, max_len).filter(F.col("reject_reason").isNull())
    return pad_and_mask(usable.drop("reject_reason"), max_len)


def reject_counts(encoded: DataFrame) -> DataFrame:
    """``(reject_reason, examples)``; kept examples count under ``kept``."""
    reason = F.coalesce("reject_reason", F.lit("kept")).alias("reject_reason")
    return encoded.groupBy(reason).agg(F.count(F.lit(1)).alias("examples"))


def encode_inference(
    df: DataFrame,
    max_len: int = settings.MAX_LEN,
    max_before_tokens: int = settings.MAX_BEFORE_TOKENS,
) -> DataFrame:
    """Encode ``(context_id, before_ids, after_ids)``: adds ``sequence`` and ``seq_len``.

    Where the token strings ``before_tokens`` and ``after_tokens`` are there too,
    ``sequence_tokens`` is cut the same way, so that a span can be read back
    without a vocabulary.  Before the image stay the last ``max_before_tokens`` tokens, cut further when
    they alone overflow; after it goes everything that still fits.  Without room
    for any context there is no row.
    """
    room = max_len - SPECIALS
    if room <= 0:
        return encode_inference(df, SPECIALS + 1, 0).filter(F.lit(False))
    keep_before = F.lit(min(max_before_tokens, room))
    columns = {"_before": sequences.tail(_ids("before_ids"), keep_before)}
    with_text = {"before_tokens", "after_tokens"} <= set(df.columns)
    if with_text:
        columns["_before_text"] = sequences.tail(F.col("before_tokens"), keep_before)
    sides = df.withColumns(columns)
    keep_after = F.lit(room) - F.size("_before")
    after = sequences.head(_ids("after_ids"), keep_after)
    sides = sides.withColumn("_after", after)
    encoded = [
        sequences.assemble(F.col("_before"), F.col("_after"), CLS_ID, IMG_ID, SEP_ID).alias("sequence"),
        (F.size("_before") + F.size("_after") + SPECIALS).alias("seq_len"),
    ]
    if with_text:
        after_text = sequences.head(F.col("after_tokens"), keep_after)
        encoded.append(
            sequences.assemble(
                F.col("_before_text"), after_text, "[CLS]", "[IMG]", "[SEP]"
            ).alias("sequence_tokens")
        )
    return sides.select(*df.columns, *encoded)


def inference_inputs(
    df: DataFrame,
    max_len: int = settings.MAX_LEN,
    max_before_tokens: int = settings.MAX_BEFORE_TOKENS,
) -> DataFrame:
    return pad_and_mask(encode_inference(df, max_len, max_before_tokens), max_len)
