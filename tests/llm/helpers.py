"""Rows that every operator has to stand."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, count, vocabulary=400):
    chosen = random.Random(seed)
    return [f"w{chosen.randrange(vocabulary)}" for _ in range(count)]


def odd_texts():
    long_text = " ".join(words(1, 30_000, 5_000))
    return [
        None, "", " ", "\n\n", "one", "a  b\t c\r\nd", "Ünïcödé 🙂 ß", "x" * 5_000, long_text,
        "the same line of several words here\nthe same line of several words here\nother",
    ]


def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ties."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(odd_texts())]
    rows += [rows[5], rows[5], (None, "text without an id and some words", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df, *names):
    from pyspark.sql import functions as F

    for name in names:
        df = df.withColumn(name, F.lit("clash"))
    return df
