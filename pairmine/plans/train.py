"""Stored training candidates to a saved span model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.operators import encoding, split, store, subwords, training, vocabulary
from pairmine.session import scratch
from pairmine.sources import tables

_TEXTS = ["context_before", "context_after", "alt_text"]


def with_token_ids(contexts: DataFrame, text_columns: list[str], vocab: DataFrame | None) -> DataFrame:
    """Contexts with token ids: hashed ones, or those of a vocabulary of words or of pieces."""
    if subwords.is_piece_vocabulary(vocab):
        return subwords.encode_pieces(contexts, text_columns, vocab)
    if vocab is None:
        return vocabulary.hashed_ids(contexts, text_columns)
    ids = vocabulary.encode_tokens(contexts, "context_id", text_columns, vocab)
    return contexts.join(ids, "context_id")


def encoded_candidates(
    contexts: DataFrame,
    max_len: int,
    max_examples: int | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Padded, labelled examples of the training candidates."""
    candidates = store.training_contexts(contexts, max_examples)
    ids = with_token_ids(candidates, _TEXTS, vocab).select(
        "context_id",
        "alt_text",
        F.col("context_before_ids").alias("before_ids"),
        F.col("context_after_ids").alias("after_ids"),
        F.col("alt_text_ids").alias("alt_ids"),
    )
    return encoding.training_examples(ids, max_len).drop("before_ids", "after_ids", "alt_ids")


def train_from_store(
    spark: SparkSession,
    root: str,
    model_dir: str,
    batch: str,
    max_len: int = settings.MAX_LEN,
    validation_split: float = settings.VALIDATION_SPLIT,
    max_examples: int | None = None,
    vocab: DataFrame | None = None,
    **training_params,
) -> DataFrame:
    """Encode, split, train, select and save; returns the metric history.

    The saved model holds ``max_len`` and ``vocab``, so that predictions use the same ids.

    The encoded set is written to the ``training_data`` table once and every
    run reads it from there.
    """
    contexts = tables.read_table(spark, root, "image_context")
    examples = encoded_candidates(contexts, max_len, max_examples, vocab)
    rows = examples.select(
        "context_id",
        "input_ids",
        "attention_mask",
        "true_start_token",
        "true_end_token",
        F.col("alt_text").alias("alt_text_used"),
        F.current_timestamp().alias("created_timestamp"),
    )
    tables.write_batch(rows, root, "training_data", batch)
    stored = spark.read.parquet(f"{root.rstrip('/')}/training_data/batch={batch}")
    seq_len = F.aggregate("attention_mask", F.lit(0), lambda acc, x: acc + x)
    labelled = stored.withColumn("seq_len", seq_len).withColumn(
        "sequence", F.slice("input_ids", F.lit(1), F.col("seq_len"))
    )
    with scratch(spark, "split-examples") as path:
        split.train_validation_split(labelled, "context_id", validation_split).write.partitionBy(
            "part"
        ).parquet(path)
        parts = spark.read.parquet(path)
        train = parts.filter("part = 'train'").drop("part")
        validation = parts.filter("part = 'validation'").drop("part")
        has_validation = not validation.isEmpty()
        model, history = training.train_span_model(
            spark, train, validation if has_validation else None, max_len, **training_params
        )
    model.max_len, model.vocab = max_len, vocab
    model.save(model_dir)
    training.write_history(history, f"{model_dir.rstrip('/')}/history")
    return history
