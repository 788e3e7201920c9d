"""Span metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.functions import spans

_SPAN = ["start_token", "end_token", "true_start_token", "true_end_token"]


def exact_match(scored: DataFrame) -> DataFrame:
    """One row ``exact_match``: share of spans with both ends right; 0 without rows."""
    hit = spans.is_exact_match(*[F.col(c) for c in _SPAN])
    share = F.avg(F.coalesce(hit, F.lit(False)).cast("double"))
    return scored.agg(F.coalesce(share, F.lit(0.0)).alias("exact_match"))


def mean_iou(scored: DataFrame) -> DataFrame:
    """One row ``iou``: mean span overlap; 0 without rows."""
    overlap = spans.span_iou(*[F.col(c) for c in _SPAN])
    return scored.agg(F.coalesce(F.avg(overlap), F.lit(0.0)).alias("iou"))
