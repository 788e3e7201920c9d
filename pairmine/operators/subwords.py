"""Sub-word ids: words cut into the pieces of a given vocabulary, longest piece first.

A vocabulary is a table ``(piece, piece_id)``; pieces that go on within a word start
with ``##``.  A task holds it as two sorted lists, looks up every distinct word of a slice of a batch
once, and spreads the answers over the words by position: a narrow pass, whatever the size of the texts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.functions import text
from pairmine.operators.vocabulary import UNKNOWN_ID

# How word-piece vocabularies mark pieces inside a word, and the longest word they cut.
INSIDE = "##"
MAX_WORD_CHARS = 100
UNKNOWN = "[UNK]"
#: Characters that a vocabulary may have in all; it is held by every task.
MAX_VOCABULARY_CHARS = 16 << 20
#: Words that are cut at a time, whatever the size of a batch.
SLICE_WORDS = 1 << 19
_PIECES = "struct<ids:array<int>,pieces:array<string>,words:array<int>>"


@dataclass
class Pieces:
    """Sorted pieces; ``shorter`` is the place of the longest other piece that each begins with, or -1."""

    texts: list[str]
    rows: np.ndarray
    shorter: np.ndarray

    @staticmethod
    def of(given: list[tuple[str, int]]) -> Pieces:
        given = sorted(given)
        shorter, opened = np.full(len(given), -1, dtype=np.int32), []
        for place, (piece, _) in enumerate(given):
            while opened and not piece.startswith(given[opened[-1]][0]):
                opened.pop()
            if opened:
                shorter[place] = opened[-1]
            opened.append(place)
        return Pieces([p for p, _ in given], np.array([r for _, r in given], dtype=np.int32), shorter)

    def longest(self, rest: str) -> int:
        """Place of the longest piece that ``rest`` begins with, or -1: what lies between that piece and ``rest`` in the order begins with the piece."""
        place = bisect_right(self.texts, rest) - 1
        while place >= 0 and not rest.startswith(self.texts[place]):
            place = int(self.shorter[place])
        return place


def build_trie(pieces: list[tuple[str, int]]) -> tuple[Pieces, Pieces, list[tuple[str, int]]]:
    """The pieces that start a word and those inside one, as sorted lists, and the pieces as given."""
    sides: tuple[list, list] = ([], [])
    for row, (piece, _) in enumerate(pieces):
        inside = piece.startswith(INSIDE) and len(piece) > len(INSIDE)
        if piece:
            sides[inside].append((piece.removeprefix(INSIDE) if inside else piece, row))
    return Pieces.of(sides[0]), Pieces.of(sides[1]), pieces


def cut_places(word: str, tries: tuple, max_chars: int = MAX_WORD_CHARS) -> list[int]:
    """Rows of a word's pieces, the longest at each place; -1 for the whole word if one place has none."""
    if len(word) > max_chars:
        return [-1]
    found, start = [], 0
    while start < len(word):
        side = tries[start > 0]
        place = side.longest(word[start:] if start else word)
        if place < 0:
            return [-1]
        found.append(int(side.rows[place]))
        start += len(side.texts[place])
    return found


def cut_word(word: str, tries: tuple, max_chars: int = MAX_WORD_CHARS) -> list[tuple[int, str]]:
    """(id, piece) of a word, the longest piece at each place; unknown as a whole if one place has none."""
    given = tries[2]
    return [(UNKNOWN_ID, UNKNOWN) if r < 0 else (given[r][1], given[r][0]) for r in cut_places(word, tries, max_chars)]


def _row_slices(lists: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """The rows in turn, so many at a time that they hold at most ``most`` words, one at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(lists):
        before = int(ends[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lists.slice(low, high - low)
        low = high


def _cutter(pieces: pa.Array, numbers: pa.Array, max_chars: int):
    # The unknown word stands behind the pieces, where row -1 finds it.
    texts = pa.concat_arrays([pieces, pa.array([UNKNOWN], pieces.type)])
    ids = pa.concat_arrays([numbers, pa.array([UNKNOWN_ID], numbers.type)])

    @F.arrow_udf(_PIECES)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        starts, insides, _ = build_trie([(p, None) for p in pieces.to_pylist()])
        tries = (starts, insides)
        for whole in batches:
            whole = whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole
            for batch in _row_slices(whole, SLICE_WORDS):
                coded = batch.flatten().dictionary_encode()
                known = [cut_places(w, tries, max_chars) for w in coded.dictionary.to_pylist()]
                sizes = np.array([len(k) for k in known], dtype=np.int32)
                flat = np.fromiter((r % len(ids) for k in known for r in k), dtype=np.int32, count=int(sizes.sum()))
                word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
                many = sizes[word] if len(word) else np.zeros(0, dtype=np.int32)
                ends = np.cumsum(many, dtype=np.int32)
                # Each word's pieces, and the place of the word in its text.
                first = np.cumsum(sizes, dtype=np.int32) - sizes
                take = flat[np.arange(int(many.sum()), dtype=np.int32) + np.repeat(first[word] - (ends - many), many)]
                lengths = pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False).astype(np.int32)
                opens = np.cumsum(lengths, dtype=np.int32) - lengths
                place = np.arange(len(word), dtype=np.int32) - np.repeat(opens, lengths)
                cuts = np.concatenate([[0], ends])[np.concatenate([opens, [len(word)]])].astype(np.int32)
                columns = [ids.take(pa.array(take)), texts.take(pa.array(take)), pa.array(np.repeat(place, many))]
                lists = [pa.ListArray.from_arrays(pa.array(cuts), c) for c in columns]
                yield pa.StructArray.from_arrays(lists, names=["ids", "pieces", "words"])
            if not len(whole):
                yield pa.array([], pa.struct([(n, pa.list_(t)) for n, t in (("ids", pa.int32()), ("pieces", pa.string()), ("words", pa.int32()))]))

    return cut


def encode_pieces(
    df: DataFrame, text_columns: list[str], vocabulary: DataFrame, max_word_chars: int = MAX_WORD_CHARS
) -> DataFrame:
    """Adds ``<column>_ids``, ``<column>_tokens`` (the pieces) and ``<column>_words`` for each text column.

    ``<column>_words`` holds for each piece the place of its word among the words of the text,
    so a span of words is the span of the pieces that carry their places.  A word that the
    pieces do not cover, or one of more than ``max_word_chars`` characters, is one
    ``UNKNOWN_ID``.  Null texts have no pieces.  A vocabulary of more than
    ``MAX_VOCABULARY_CHARS`` characters is refused.
    """
    size = vocabulary.agg(F.sum(F.length("piece") + 16)).first()[0] or 0
    if size > MAX_VOCABULARY_CHARS:
        raise ValueError(f"a vocabulary of {size} characters is too large for every task")
    given = vocabulary.select("piece", F.col("piece_id").cast("int").alias("piece_id")).toArrow()  # bounded above
    pieces, numbers = (given.column(c).combine_chunks() for c in ("piece", "piece_id"))
    cut = _cutter(pieces.cast(pa.string()), numbers, max_word_chars)
    whole = df.withColumns({f"_{c}": cut(text.tokenize(F.col(c))) for c in text_columns})
    parts = {
        f"{c}_{name}": F.col(f"_{c}.{part}")
        for c in text_columns
        for name, part in (("ids", "ids"), ("tokens", "pieces"), ("words", "words"))
    }
    return whole.withColumns(parts).drop(*[f"_{c}" for c in text_columns])


def is_piece_vocabulary(vocabulary: DataFrame | None) -> bool:
    return vocabulary is not None and "piece" in vocabulary.columns
