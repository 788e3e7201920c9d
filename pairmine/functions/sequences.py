"""Token-array expressions: truncation, assembly, padding, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def head(tokens: Column, count: Column) -> Column:
    """The first ``count`` tokens; none for a count below one."""
    return F.slice(tokens, F.lit(1), F.greatest(count, F.lit(0)))


def tail(tokens: Column, count: Column) -> Column:
    """The last ``count`` tokens; none for a count below one."""
    size = F.size(tokens)
    start = F.greatest(size - count + 1, F.lit(1))
    return F.when(count > 0, F.slice(tokens, start, F.greatest(count, F.lit(1)))).otherwise(
        F.slice(tokens, F.lit(1), F.lit(0))
    )


def assemble(before: Column, after: Column, cls_id, img_id, sep_id) -> Column:
    """``[CLS] before [IMG] after [SEP]``."""
    return F.concat(
        F.array(F.lit(cls_id)), before, F.array(F.lit(img_id)), after, F.array(F.lit(sep_id))
    )


def pad(sequence: Column, max_len: int, pad_id) -> Column:
    """Right-padded to ``max_len``."""
    missing = F.greatest(F.lit(max_len) - F.size(sequence), F.lit(0))
    return F.concat(sequence, F.array_repeat(F.lit(pad_id), missing))


def attention_mask(length: Column, max_len: int) -> Column:
    """One for every real position, zero for the padding."""
    missing = F.greatest(F.lit(max_len) - length, F.lit(0))
    return F.concat(F.array_repeat(F.lit(1), length), F.array_repeat(F.lit(0), missing))
