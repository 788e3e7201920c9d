"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the distinct windows of consecutive benchmark words.  Words become
numbers, so a text is a sequence of numbers and a block is two neighbouring ones.
Shift tables over hashed blocks skip the positions at which no pattern can end; where
the shift is zero, the bucket of the last block, narrowed by the first block, selects
patterns, and a direct comparison of all words confirms the occurrence.  The search
walks many stretches of the texts at the same time, one numpy step for all, and a
stretch ends where its neighbour starts, so long texts cost no more than short ones.

The patterns of one pass are bounded (``max_windows``); more of them make more passes
over the same rows, each with tables of bounded size, chained in one narrow stage.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code

WINDOW = 10
MAX_WINDOWS = 200_000
#: A word: digits, lower-case ASCII letters and everything beyond ASCII, in UTF-8 bytes.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STRETCH = 512
_BATCH_WORDS = 150_000


def split_words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


class Search:
    """Tables for all patterns of ``size`` words."""

    SHIFT_BITS = 20

    def __init__(self, patterns: np.ndarray):
        """``patterns``: one row of word numbers, all above zero, per pattern."""
        self.size = patterns.shape[1]
        self.width = min(2, self.size)
        first = self._block(patterns[:, 0], patterns[:, self.width - 1])
        last = self._block(patterns[:, -self.width], patterns[:, -1])
        key = self._join(last, first)
        self.order = np.argsort(key, kind="stable")
        self.patterns, self.key = patterns[self.order], key[self.order]
        self.shift = np.full(1 << self.SHIFT_BITS, self.size - self.width + 1, dtype=np.int32)
        for end in range(self.width, self.size + 1):
            block = self._block(patterns[:, end - self.width], patterns[:, end - 1])
            np.minimum.at(self.shift, self._slot(block), np.int32(self.size - end))

    def _block(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if self.width == 1:
            return right.astype(np.uint64)
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, block: np.ndarray) -> np.ndarray:
        spread = block * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.SHIFT_BITS)).astype(np.int64)

    @staticmethod
    def _join(last: np.ndarray, first: np.ndarray) -> np.ndarray:
        mixed = (last ^ (last >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return mixed ^ ((first ^ (first >> np.uint64(29))) * np.uint64(0x94D049BB133111EB))

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start positions of all occurrences in ``words``, and which pattern is there."""
        none = np.zeros(0, dtype=np.int64)
        if len(words) < self.size:
            return none, none
        # ``at`` is the last word of a window; every stretch has its own.
        at = np.arange(self.size - 1, len(words), _STRETCH, dtype=np.int64)
        end = np.minimum(at + _STRETCH, len(words))
        zero = []
        while len(at):
            block = self._block(words[at - (self.width - 1)], words[at])
            shift = self.shift[self._slot(block)]
            zero.append(at[shift == 0])
            at = at + np.maximum(shift, 1)
            alive = at < end
            at, end = at[alive], end[alive]
        ends = np.concatenate(zero)
        starts = ends - (self.size - 1)
        first = self._block(words[starts], words[starts + self.width - 1])
        last = self._block(words[ends - (self.width - 1)], words[ends])
        key = self._join(last, first)
        slot = np.searchsorted(self.key, key, side="left")
        stop = np.searchsorted(self.key, key, side="right")
        found_at, found = [none], [none]
        while True:
            open_ = np.flatnonzero(slot < stop)
            if not len(open_):
                break
            slot, stop, starts = slot[open_], stop[open_], starts[open_]
            same = np.ones(len(slot), dtype=bool)
            for k in range(self.size):
                same &= words[starts + k] == self.patterns[slot, k]
            found_at.append(starts[same])
            found.append(self.order[slot[same]])
            slot = slot + 1
        return np.concatenate(found_at), np.concatenate(found)


class Patterns:
    """Windows of benchmark items, by their number of words, and who has them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        numbers: dict[bytes, int] = {}
        owners: dict[int, dict[tuple, list[int]]] = {}
        self.items = [item for item, _ in items]
        for number, (_, words) in enumerate(items):
            ids = [numbers.setdefault(w, len(numbers) + 1) for w in words]
            size = min(window, len(ids))
            for start in range(len(ids) - size + 1 if size else 0):
                holders = owners.setdefault(size, {}).setdefault(tuple(ids[start : start + size]), [])
                if not holders or holders[-1] != number:
                    holders.append(number)
        self.numbers = numbers
        self.searches = [
            (Search(np.array(list(by_window), dtype=np.int64)), [np.array(h) for h in by_window.values()])
            for _, by_window in sorted(owners.items())
        ]

    def search(self, words: list[list[bytes]]) -> tuple[list[np.ndarray], list[set[str]]]:
        """Per text: which words are inside an occurrence, and the items that occur."""
        get = self.numbers.get
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        # One word that no pattern has stands between texts.
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])
        flat = np.zeros(starts[-1], dtype=np.int64)
        for text, start in zip(words, starts, strict=False):
            if text:
                flat[start : start + len(text)] = [get(w, 0) for w in text]
        edge = np.zeros(len(flat) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in words]
        for search, owners in self.searches:
            at, which = search.find(flat)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + search.size, -1)
            of = np.searchsorted(starts, at, side="right") - 1
            for text, pattern in set(zip(of.tolist(), which.tolist(), strict=True)):
                items[text].update(self.items[i] for i in owners[pattern] if self.items[i] is not None)
        covered = np.cumsum(edge)[:-1] > 0
        return [covered[s : s + n] for s, n in zip(starts, lengths, strict=False)], items


def _runs(mask: np.ndarray) -> list[int]:
    """Flat list of the starts and ends of the covered stretches."""
    return np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))).tolist()


def _found_words(batch: pa.RecordBatch, patterns: Patterns, text: int, hits: int, items: int):
    """Search the rows of a batch in blocks of bounded size; new hits and items."""
    all_hits, all_items, all_counts = [], [], []
    texts = batch.column(text)
    old_hits, old_items = batch.column(hits), batch.column(items)
    row = 0
    while row < len(texts):
        block, held = [], 0
        first = row
        while row < len(texts) and (not block or held < _BATCH_WORDS):
            block.append(split_words(texts[row].as_py()))
            held += len(block[-1])
            row += 1
        masks, found = patterns.search(block)
        for k, (mask, names) in enumerate(zip(masks, found, strict=True)):
            before = old_hits[first + k].as_py()
            if before:
                for a, b in zip(before[::2], before[1::2], strict=True):
                    mask[a:b] = True
            all_hits.append(_runs(mask) if before or names else [])
            all_items.append(sorted(names.union(old_items[first + k].as_py())))
            all_counts.append(len(mask))
    return all_counts, all_hits, all_items


_built: dict[str, Patterns] = {}


def _patterns(shared) -> Patterns:
    """The tables of a pass, built once per worker."""
    name, items, window = shared.value
    if name not in _built:
        _built.clear()
        _built[name] = Patterns(items, window)
    return _built[name]


def _pass(batches: Iterator[pa.RecordBatch], shared, keep_text: bool):
    patterns = _patterns(shared)
    for batch in batches:
        schema = batch.schema
        place = {name: k for k, name in enumerate(schema.names)}
        counts, hits, items = _found_words(batch, patterns, place["text"], place["hits"], place["items"])
        columns = list(batch.columns)
        columns[place["n_words"]] = pa.array(counts, pa.int64())
        columns[place["hits"]] = pa.array(hits, pa.list_(pa.int64()))
        columns[place["items"]] = pa.array(items, pa.list_(pa.string()))
        names = [n for n in schema.names if keep_text or n != "text"]
        yield pa.RecordBatch.from_arrays([columns[place[n]] for n in names], names=names)


def _blocks(benchmark: DataFrame, window: int, max_windows: int) -> Iterator[list]:
    """The items in blocks of at most ``max_windows`` windows, one at a time.

    An item of more windows is cut where its windows allow it, so that no block
    grows with the length of an item.
    """
    held, size = [], 0
    rows = benchmark.select(
        F.col("item_id").cast("string").alias("item"), F.col("text").alias("text")
    ).filter("text is not null")
    for row in rows.toLocalIterator():
        words = split_words(row["text"])
        if not words:
            continue
        step = max_windows if len(words) > window else len(words)
        for start in range(0, max(1, len(words) - window + 1), step):
            part = words[start : start + step + window - 1]
            held.append((row["item"], part))
            size += max(1, len(part) - window + 1)
            if size >= max_windows:
                yield held
                held, size = [], 0
    if held:
        yield held


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
    keep_text: bool = True,
) -> DataFrame:
    """``docs`` (doc_id, text) with the benchmark passages found in them.

    Adds ``n_words``, ``hits`` (starts and ends of the covered word stretches, flat)
    and ``items`` (sorted ids, as strings, of the items that occur).  Windows are
    ``window`` consecutive words of an item; a shorter item is one window.  Null
    and empty texts have no words and no hits, a null item text has no window, an item
    with a null id is found but not named, repeated rows are searched each on its
    own, and all columns of ``docs`` are kept except those of the three new names.
    The tables of a pass hold at most about ``max_windows`` windows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "hits", "items")]
    found = docs.select(
        *[docs[c] for c in kept],
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<long>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    blocks = _blocks(benchmark, window, max_windows)
    block = next(blocks, [])
    blocks_done = bool(block)
    while block:
        after = next(blocks, [])
        found = _apply(found, block, window, keep_text or bool(after))
        block = after
    done = blocks_done or keep_text
    return found if done else _apply(found, [], window, False)


def _apply(found: DataFrame, items: list, window: int, keep_text: bool) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, items, window))
    out = found if keep_text else found.drop("text")
    return found.mapInArrow(lambda batches: _pass(batches, shared, keep_text), out.schema)


def hit_words() -> Column:
    """Number of words in the stretches of ``hits``."""
    return F.aggregate(
        F.expr("transform(hits, (x, i) -> if(i % 2 = 1, x, -x))"), F.lit(0).cast("long"), lambda a, x: a + x
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which a benchmark passage occurs."""
    found = find_contamination(docs, benchmark)
    return found.filter(F.size("hits") == 0).select(*[found[c] for c in docs.columns])
