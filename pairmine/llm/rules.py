"""Quality rules with thresholds from mergeable quantile sketches, in DataFrame functions only.

Each measure of a document falls into a bucket of a fixed grid (whole thousandths of a
share, sixteenths of a character), and the sketch of a language and source
is the count of each bucket.  Counts add up, so sketches merge in any order, give the
same quantiles however the rows are dealt, and hold a bounded number of rows per
group.  A measure is an outlier beyond the upper quartile by ``FENCE`` interquartile ranges
of its group, and at least ``MARGIN``; groups of fewer than ``MIN_GROUP`` documents use
the sketch of their language, and then that of all rows.  Thresholds are joined to the
documents by group; they are few rows per group, and groups are counted first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmine.llm.rows import sized
from pairmine.session import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
FENCE = 3
MIN_GROUP = 30
#: Measures, and the least distance of their threshold from the upper quartile, in buckets.
MARGINS = {"symbol_share": 50, "dup_line_share": 300, "repeat_share": 200, "word_length": 24}
_GAPS = "[ \\t\\x0b\\x0c\\r\\n]+"
_HAS_WORD = "[^ \\t\\x0b\\x0c\\r\\n]"
_SYMBOLS = "[^#*$%&|<>]+"


def base_counts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    ``n_lines`` counts lines with a word.  A null text has no words and no lines.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    held = docs.select(
        *[docs[c] for c in keep],
        F.length(F.regexp_replace(text, _GAPS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, _SYMBOLS, "")).cast("long").alias("n_symbols"),
        # Generators keep the arrays from being computed once per use.
        F.explode(F.array(F.transform(F.split(text, _GAPS), lambda w: F.xxhash64(w)))).alias("_h"),
        text.alias("_text"),
    )
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(_HAS_WORD))
    trimmed = F.expr(
        "slice(_h, if(_h[0] = xxhash64(''), 2, 1), size(_h) - if(_h[0] = xxhash64(''), 1, 0)"
        " - if(size(_h) > 1 and _h[size(_h) - 1] = xxhash64(''), 1, 0))"
    )
    listed = held.select(
        *keep, "word_chars", "n_symbols", trimmed.alias("_w"), F.explode(F.array(lines)).alias("_lines")
    )
    counted = listed.select(
        *keep,
        "word_chars",
        "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "_w",
    )
    windows = F.expr(
        "if(size(_w) < 3, array(), zip_with(zip_with(slice(_w, 1, size(_w) - 2), slice(_w, 2, size(_w) - 2), (a, b) -> xxhash64(a, b)),"
        " slice(_w, 3, size(_w) - 2), (ab, c) -> xxhash64(ab, c)))"
    )
    with_windows = counted.withColumn("_v", F.explode(F.array(windows.cast("array<bigint>"))))
    repeats = F.expr(
        "if(size(_v) = size(array_distinct(_v)), array(), sort_array(transform(_v, (v, i) -> named_struct('v', v, 'i', i))))"
    )
    repeated = with_windows.select(*[c for c in with_windows.columns if c[0] != "_"], F.explode(F.array(repeats)).alias("_o"))
    return repeated.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        _words_in_repeats().cast("long").alias("n_repeat_words"),
    )


def _words_in_repeats() -> Column:
    """Words inside windows that occur more than once.

    The windows are sorted by hash and place; neighbours of equal hash are repeats.  Their
    places, in order, cover three words each, less what the one before covers.
    """
    neighbours = "zip_with(slice(_o, 1, greatest(size(_o) - 1, 0)), slice(_o, 2, greatest(size(_o) - 1, 0)), (a, b) -> if(a.v = b.v, array(a.i, b.i), array()))"
    return F.expr(
        f"aggregate(sort_array(array_distinct(flatten({neighbours}))), named_struct('last', -3, 'n', 0),"
        " (s, i) -> named_struct('last', i, 'n', s.n + least(3, i - s.last)), s -> s.n)"
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _measures() -> dict[str, Column]:
    """Bucket of each measure: thousandths of the words or lines, sixteenths of a character."""
    return {
        "symbol_share": F.expr("least(n_symbols * 1000 div greatest(n_words, 1), 10000)"),
        "dup_line_share": F.expr("n_dup_lines * 1000 div greatest(n_lines, 1)"),
        "repeat_share": F.expr("n_repeat_words * 1000 div greatest(n_words, 1)"),
        "word_length": F.expr("least(word_chars * 16 div greatest(n_words, 1), 10000)"),
    }


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the bucket counts of every group."""
    listed = [F.struct(F.lit(k).alias("measure"), F.col(k).cast("long").alias("bucket")) for k in MARGINS]
    return (
        measured.select("lang", "source", F.explode(F.array(*listed)).alias("m"))
        .groupBy("lang", "source", F.col("m.measure").alias("measure"), F.col("m.bucket").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketch: DataFrame, *group: str) -> DataFrame:
    """(group, measure, size, q1, q3) of merged sketches; the first bucket that reaches a quarter."""
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    of = Window.partitionBy(*group, "measure")
    upto = of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.select(
        *group, "measure", "bucket", F.sum("n").over(upto).alias("upto"), F.sum("n").over(of).alias("size")
    )
    return ranked.groupBy(*group, "measure").agg(
        F.max("size").alias("size"),
        F.min(F.when(4 * F.col("upto") >= F.col("size"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("size"), F.col("bucket"))).alias("q3"),
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """(lang, source, and a threshold per measure), the group's own or that of a wider one."""
    sketch = stage(sketches(measured), "sketches")
    own = quartiles(sketch, "lang", "source")
    by_lang = quartiles(sketch, "lang").toDF("l_lang", "l_measure", "l_size", "l_q1", "l_q3")
    overall = quartiles(sketch).toDF("o_measure", "o_size", "o_q1", "o_q3")
    joined = own.join(
        by_lang, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure"))
    ).join(overall, F.col("measure") == F.col("o_measure"))

    def pick(column: str) -> Column:
        wide = F.when(F.col("l_size") >= MIN_GROUP, F.col(f"l_{column}")).otherwise(F.col(f"o_{column}"))
        return F.when(F.col("size") >= MIN_GROUP, F.col(column)).otherwise(wide)

    margin = F.element_at(F.create_map(*[F.lit(x) for kv in MARGINS.items() for x in kv]), F.col("measure"))
    limit = pick("q3") + F.greatest(FENCE * (pick("q3") - pick("q1")), margin)
    flat = joined.select("lang", "source", "measure", limit.alias("limit"))
    return flat.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == k, F.col("limit"))).alias(f"max_{k}") for k in MARGINS]
    )


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts, base_failed and kept, for every row of ``docs``.

    A document is kept if it passes the base rules and no measure exceeds the threshold of
    its language and source.  Null languages and sources are groups like any other; a
    null or empty text has no words and fails; repeated rows are judged each.
    """
    counts = stage(base_counts(docs), "base-counts")
    measured = counts.withColumns(_measures())
    limits = thresholds(measured).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    limits = sized(limits, "thresholds")
    joined = measured.join(
        limits, measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"]), "left"
    )
    outlier = F.lit(False)
    for name in MARGINS:
        outlier = outlier | (F.col(name) > F.col(f"max_{name}"))
    return joined.select(
        *counts.columns,
        base_failed().alias("base_failed"),
        (~base_failed() & ~F.coalesce(outlier, F.lit(False))).alias("kept"),
    )
