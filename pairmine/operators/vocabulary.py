"""Corpus vocabulary and token ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmine import settings
from pairmine.functions import text
from pairmine.session import stage

# Ids of the special tokens; corpus tokens follow.
PAD_ID = 0
UNKNOWN_ID = 1
CLS_ID = 2
SEP_ID = 3
IMG_ID = 4
SPECIAL_TOKENS = {"[PAD]": 0, "[UNK]": 1, "[CLS]": 2, "[SEP]": 3, "[IMG]": 4}
FIRST_TOKEN_ID = 5

HASH_BUCKETS = 1 << 20
CHUNK_CHARS = 8 << 20  # of texts whose distinct tokens are looked up together
_BUCKET_DIGITS = 3  # 16^3 buckets, whatever the size of the vocabulary


def token_counts(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """``(token, n)`` over all given text columns, pre-aggregated before the shuffle."""
    tokens = F.concat(*[text.tokenize(F.col(c)) for c in text_columns])
    exploded = df.select(F.explode(tokens).alias("token"))
    return exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def number_tokens(counts: DataFrame) -> DataFrame:
    """``(token, n, token_id)`` with dense ids in the order of (hash bucket, token).

    Hash buckets of distinct tokens are even, so numbering inside a bucket is
    spread over all tasks; only the bucket sizes, at most 4096 rows, are summed
    up in one place and broadcast.
    """
    bucket = F.substring(F.md5(F.col("token").cast("binary")), 1, _BUCKET_DIGITS)
    bucketed = counts.withColumn("bucket", bucket)
    sizes = bucketed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("bucket", (F.sum("size").over(running) - F.col("size")).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("token"))
    return (
        bucketed.withColumn("inside", inside)
        .join(F.broadcast(offsets), "bucket")
        .select(
            "token",
            "n",
            (F.col("offset") + F.col("inside") + (FIRST_TOKEN_ID - 1)).cast("int").alias("token_id"),
        )
    )


def build_vocabulary(df: DataFrame, text_columns: list[str]) -> DataFrame:
    """Vocabulary of a corpus.

    The token counts are staged: numbering reads them twice, the corpus is read
    once.  Write the result before encoding, which reads it more than once.
    """
    return number_tokens(stage(token_counts(df, text_columns), "token-counts"))


def hashed_ids(df: DataFrame, text_columns: list[str], buckets: int = HASH_BUCKETS) -> DataFrame:
    """Adds ``<column>_tokens`` and ``<column>_ids`` for each text column.

    Needs no vocabulary and no shuffle.  Ids are not dense and two tokens may
    share one; the token strings stay beside them.
    """
    tokens = df.withColumns({f"{c}_tokens": text.tokenize(F.col(c)) for c in text_columns})
    return tokens.withColumns(
        {
            f"{c}_ids": text.hash_ids(F.col(f"{c}_tokens"), FIRST_TOKEN_ID, buckets)
            for c in text_columns
        }
    )


def encode_tokens(
    df: DataFrame,
    key: str,
    text_columns: list[str],
    vocabulary: DataFrame,
    vocabulary_rows: int | None = None,
    hot_tokens: int = 1_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """``(key, <column>_ids…)``: the token ids of each text, in order.

    Unknown tokens get UNKNOWN_ID.  ``key`` is unique.  The texts are dealt by the hash of their key into chunks of
    about ``CHUNK_CHARS`` characters.  Only the distinct tokens of a chunk meet the vocabulary, so no token comes
    more than once a chunk, however frequent it is; chunk and answers then meet by the number of the chunk.  What is
    shuffled is the texts and these small dictionaries, never single occurrences.  A vocabulary of
    at most ``BROADCAST_ROW_LIMIT`` rows (counted here unless given) is broadcast.  ``hot_tokens``
    is accepted for earlier callers: frequent tokens need no spreading any more.

    With ``keep``, columns of ``df``, there is a row for every row of ``df`` with a key, and it has
    these columns and ``<column>_tokens`` too: no join is needed to bring them together.
    """
    rows = vocabulary.count() if vocabulary_rows is None else vocabulary_rows
    chars = df.agg(F.sum(sum((F.coalesce(F.length(c), F.lit(0)) for c in text_columns), F.lit(0)))).first()[0] or 0
    chunks = max(df.sparkSession.sparkContext.defaultParallelism, -(-chars // CHUNK_CHARS))
    kept = [c for c in keep or [] if c != key]
    given = df if keep is None else df.filter(F.col(key).isNotNull())
    dealt = given.select(
        F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int").alias("_chunk"),
        key,
        *[F.col(c).alias(f"_text{i}") for i, c in enumerate(text_columns)],
        *[F.col(c).alias(f"_kept{i}") for i, c in enumerate(kept)],
    ).repartition(chunks, "_chunk")
    tokens = [text.tokenize(F.col(f"_text{i}")) for i in range(len(text_columns))]
    sought = dealt.select("_chunk", F.explode(F.array_distinct(F.concat(*tokens))).alias("token")).distinct()
    lookup = vocabulary.select("token", "token_id")
    if rows <= settings.BROADCAST_ROW_LIMIT:
        found = sought.join(F.broadcast(lookup), "token")
    else:
        found = sought.join(lookup, "token").repartition(chunks, "_chunk")
    texts = dealt.select(
        "_chunk",
        F.col(key).alias("_key"),
        *[t.alias(f"{c}_tokens") for t, c in zip(tokens, text_columns, strict=True)],
        *[f"_kept{i}" for i in range(len(kept))],
    )
    names = [f"{c}_ids" for c in text_columns]
    words = [f"{c}_tokens" for c in text_columns]
    extra = [] if keep is None else [*words, *[f"_kept{i}" for i in range(len(kept))]]
    schema = T.StructType(
        [texts.schema["_key"]]
        + [texts.schema[c] for c in extra]
        + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]
    )
    answers = found.select(F.col("_chunk").alias("_of"), "token", "token_id")
    coded = (
        texts.groupBy("_chunk")
        .cogroup(answers.groupBy("_of"))
        .applyInArrow(_chunk_coder(words, names, extra), schema)
    )
    held = [] if keep is None else [*words, *[F.col(f"_kept{i}").alias(c) for i, c in enumerate(kept)]]
    return coded.select(F.col("_key").alias(key), *held, *names)


def _chunk_coder(words: list[str], names: list[str], extra: list[str]):
    """The ids of a chunk's tokens by its small dictionary, all tokens of a column at once."""

    def code(texts: pa.Table, found: pa.Table) -> pa.Table:
        known = found.column("token").combine_chunks()
        numbers = found.column("token_id").combine_chunks()
        starts, flats = [], []
        for column in words:
            lists = texts.column(column).combine_chunks()
            place = pc.index_in(lists.flatten(), value_set=known)
            flats.append(pc.fill_null(numbers.take(place), UNKNOWN_ID).to_numpy(zero_copy_only=False).astype(np.int32))
            starts.append(np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64))
        owner = texts.column("_key").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, first, group, sizes = np.unique(owner, return_index=True, return_inverse=True, return_counts=True)
        columns = [pa.ListArray.from_arrays(pa.array(s.astype(np.int32)), pa.array(f)) for s, f in zip(starts, flats, strict=True)]
        if len(first) < len(owner):
            columns = _of_repeated(columns, first, group, sizes)
        rows = texts if extra else texts.take(pa.array(np.sort(first)))
        if not extra:
            columns = [c.take(pa.array(np.sort(first))) for c in columns]
        return pa.Table.from_arrays(
            [rows.column("_key"), *[rows.column(c) for c in extra], *columns], names=["_key", *extra, *names]
        )

    return code


def _of_repeated(columns: list[pa.ListArray], first: np.ndarray, group: np.ndarray, sizes: np.ndarray) -> list[pa.ListArray]:
    """Rows that share a key count as one text: their ids by place, then by id, cut to the lengths of the first."""
    lists = [c.to_pylist() for c in columns]
    members: dict[int, list[int]] = {}
    for row in np.flatnonzero(sizes[group] > 1).tolist():
        members.setdefault(int(group[row]), []).append(row)
    for number, own in members.items():
        wholes = [[i for column in lists for i in column[row]] for row in own]
        merged = [i for _, i in sorted((place, i) for whole in wholes for place, i in enumerate(whole))]
        lengths, cuts = [len(column[int(first[number])]) for column in lists], 0
        for column, length in zip(lists, lengths, strict=True):
            for row in own:
                column[row] = merged[cuts : cuts + length]
            cuts += length
    return [pa.array(c, pa.list_(pa.int32())) for c in lists]
