"""Stored contexts to stored predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.operators import encoding, prediction, store, subwords
from pairmine.operators.training import PointerModel
from pairmine.operators.vocabulary import encode_tokens, hashed_ids
from pairmine.sources import tables


def inference_inputs(
    contexts: DataFrame,
    max_len: int = settings.MAX_LEN,
    max_before_tokens: int = settings.MAX_BEFORE_TOKENS,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """Padded sequences of contexts, with their token strings.

    The ids are hashed ones, without a shuffle, or those of a vocabulary of words or of pieces.
    """
    texts = ["context_before", "context_after"]
    given = contexts.select("context_id", *texts)
    if subwords.is_piece_vocabulary(vocab):
        coded = subwords.encode_pieces(given, texts, vocab)
    else:
        coded = hashed_ids(given, texts)
    if vocab is not None and not subwords.is_piece_vocabulary(vocab):
        known = encode_tokens(contexts, "context_id", texts, vocab)
        coded = coded.drop(*[f"{c}_ids" for c in texts]).join(known, "context_id")
    ids = coded.select(
        "context_id",
        F.col("context_before_ids").alias("before_ids"),
        F.col("context_after_ids").alias("after_ids"),
        F.col("context_before_tokens").alias("before_tokens"),
        F.col("context_after_tokens").alias("after_tokens"),
    )
    encoded = encoding.inference_inputs(ids, max_len, max_before_tokens)
    return encoded.select("context_id", "input_ids", "attention_mask", "seq_len", "sequence_tokens")


def predict_from_store(
    spark: SparkSession,
    root: str,
    model_path: str,
    batch: str,
    make_predict_fn: Callable | None = None,
    max_len: int | None = None,
    max_before_tokens: int = settings.MAX_BEFORE_TOKENS,
    batch_size: int = settings.PREDICTION_BATCH,
    method: str = "geometric",
    vocab: DataFrame | None = None,
) -> dict[str, int]:
    """Score every context that this model has not scored yet; append the valid spans.

    Contexts with a stored prediction of the model are left out before the model
    runs.  A saved model brings the vocabulary and the length it was trained with; another
    length is refused.  ``make_predict_fn`` replaces the saved model, and then ``vocab``
    and ``max_len`` say what its inputs are.
    """
    if make_predict_fn is None:
        model = PointerModel.load(model_path)
        if vocab is not None or max_len not in (None, model.max_len):
            raise ValueError(f"the model at {model_path} has its own vocabulary and length {model.max_len}")
        make_predict_fn, vocab, max_len = model.make_predict_fn(), model.vocab, model.max_len
    max_len = settings.MAX_LEN if max_len is None else max_len
    done = (
        tables.read_table(spark, root, "predicted_descriptions", without_batch=batch)
        .filter(F.col("model_path") == model_path)
        .select("context_id")
    )
    contexts = store.inference_contexts(tables.read_table(spark, root, "image_context"))
    attempted, added = Observation("attempted"), Observation("added")
    inputs = inference_inputs(
        store.unprocessed(contexts, done, "context_id"), max_len, max_before_tokens, vocab
    ).observe(attempted, F.count(F.lit(1)).alias("attempted"))
    logits = prediction.predict_logits(inputs, make_predict_fn, max_len, batch_size)
    spans = prediction.decode_predictions(logits, method)
    rows = store.to_prediction_rows(spans, model_path).observe(
        added, F.count(F.lit(1)).alias("added")
    )
    tables.write_batch(rows, root, "predicted_descriptions", batch)
    return {**attempted.get, **added.get}
