"""Span expressions: argmax, softmax, confidences, decoding, overlap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spaces that joining tokens leaves before punctuation and clitics.
SPACING = [
    (" .", "."), (" ?", "?"), (" !", "!"), (" ,", ","), (" ' ", "'"),
    (" n't", "n't"), (" 'm", "'m"), (" 's", "'s"), (" 've", "'ve"), (" 're", "'re"),
]


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def argmax(logits: Column) -> Column:
    """Position of the first maximum, from zero; null for an empty array."""
    return (F.nullif(F.array_position(logits, F.array_max(logits)), F.lit(0)) - 1).cast("int")


def softmax(logits: Column) -> Column:
    """Probabilities over the whole array, in double precision."""
    exps = _let(
        F.array_max(logits),
        lambda top: F.transform(logits, lambda x: F.exp(x.cast("double") - top.cast("double"))),
    )
    return _let(
        exps,
        lambda e: _let(
            F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x),
            lambda total: F.transform(e, lambda x: x / total),
        ),
    )


def peak_probability(logits: Column) -> Column:
    """Softmax value at the maximum, without building the whole distribution."""
    return _let(
        F.array_max(logits).cast("double"),
        lambda top: F.lit(1.0)
        / F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top)),
    )


def cross_entropy(logits: Column, target: Column) -> Column:
    """Negative log softmax at ``target``."""
    return _let(
        F.array_max(logits).cast("double"),
        lambda top: top
        + F.ln(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top)))
        - F.get(logits, target).cast("double"),
    )


def is_valid_span(start: Column, end: Column, length: Column) -> Column:
    return F.coalesce((start >= 0) & (start <= end) & (end < length), F.lit(False))


def span_confidence(start: Column, end: Column, method: str = "geometric") -> Column:
    """Joint confidence: geometric mean, or plain product."""
    if method == "geometric":
        return F.sqrt(start * end)
    if method == "product":
        return start * end
    raise ValueError(f"unknown method: {method}")


def span_text(tokens: Column, start: Column, end: Column, specials: list[str]) -> Column:
    """Tokens ``start`` to ``end`` (inclusive) as text, special tokens dropped.

    Pieces that go on within a word (``##…``) are joined to what stands before them.
    """
    inside = F.slice(tokens, start + 1, F.greatest(end - start + 1, F.lit(0)))
    words = F.filter(inside, lambda t: ~t.isin(specials))
    joined = F.regexp_replace(F.replace(F.array_join(words, " "), F.lit(" ##"), F.lit("")), "^##(?=.)", "")
    for spaced, tight in SPACING:
        joined = F.replace(joined, F.lit(spaced), F.lit(tight))
    return F.btrim(joined)


def span_iou(pred_start: Column, pred_end: Column, true_start: Column, true_end: Column) -> Column:
    """Overlap of two inclusive integer intervals; 0 when either is inverted."""
    inter = F.greatest(
        F.lit(0), F.least(pred_end, true_end) - F.greatest(pred_start, true_start) + 1
    )
    union = (pred_end - pred_start + 1) + (true_end - true_start + 1) - inter
    valid = (pred_start <= pred_end) & (true_start <= true_end)
    return F.when(valid, inter / union).otherwise(F.lit(0.0))


def is_exact_match(pred_start, pred_end, true_start, true_end) -> Column:
    return (pred_start == true_start) & (pred_end == true_end)
