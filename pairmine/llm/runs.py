"""Periodic runs of words, by recompression.

A run is a stretch of words with a smallest period that fits into it at least
``MIN_REPEATS`` times and that no neighbouring word extends.  Candidates come from a
harmonic grid: for a period p, every ``max(p, GRID)``-th word is compared with the word p
further on, and two neighbouring grid words must agree.  A run of at least ``MIN_WORDS``
words covers two of them, so none is missed, and the grids of all periods together
have n log n points.

The texts that have candidates are compressed into a grammar: equal neighbours become
a block, then chosen pairs become one symbol, in turns, until few symbols are left.
Equal stretches are compressed alike but for their ends, so the longest common
extension of two places is found by walking up while both stand at the start of a
symbol, and down again at the first difference.  The extensions of a candidate to both
sides are its run.

A task joins many texts, a separator of its own after each, and compresses them
together; a long text is a chunk by itself.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code

MIN_WORDS = 24
MIN_REPEATS = 3
#: Grid step of short periods.  A run's words agree with those one period on over at
#: least MIN_WORDS - p and (MIN_REPEATS - 1) * p words: two steps, whatever p is.
GRID = MIN_WORDS // MIN_REPEATS
CHUNK_WORDS = 500_000
_FEW = 8
_ROUNDS = 200
_QUERIES = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)

RUN = "struct<start:long,length:long,period:long>"


# --- grammar --------------------------------------------------------------------


def _side(symbols: np.ndarray, salt: int) -> np.ndarray:
    """A bit per symbol."""
    mixed = (symbols.astype(np.uint64) + np.uint64(salt)) * _ODD
    return ((mixed ^ (mixed >> np.uint64(29))) * _ODD >> np.uint64(63)).astype(bool)


class Grammar:
    """A run-length grammar over symbols >= 0; each separator is a negative symbol of its own.

    Level by level: ``symbol``, the ``parent`` of each symbol one level up, the ``first``
    child of each symbol one level up, and whether the level above holds blocks.
    """

    def __init__(self, symbols: np.ndarray):
        self.levels: list[dict] = []
        self._next = int(symbols.max(initial=-1)) + 1
        for salt in range(_ROUNDS):
            symbols = self._blocks(symbols)
            ends = np.flatnonzero(symbols < 0)
            if len(ends) < 2 or np.diff(ends).max() <= _FEW + 1:
                break
            symbols = self._pairs(symbols, salt)
        self.levels.append({"symbol": symbols})

    def _name(self, keys: np.ndarray) -> np.ndarray:
        """Equal keys get one new symbol."""
        known, place = np.unique(keys, return_inverse=True)
        self._next += len(known)
        return place + (self._next - len(known))

    def _level(self, symbols: np.ndarray, first: np.ndarray, blocks: bool) -> None:
        size = np.diff(first)
        parent = np.repeat(np.arange(len(size)), size)
        self.levels.append({"symbol": symbols, "parent": parent, "first": first, "blocks": blocks})

    def _blocks(self, symbols: np.ndarray) -> np.ndarray:
        opens = np.ones(len(symbols), dtype=bool)
        opens[1:] = symbols[1:] != symbols[:-1]
        if opens.all():
            return symbols
        first = np.append(np.flatnonzero(opens), len(symbols))
        size = np.diff(first)
        above = symbols[first[:-1]].copy()
        many = size > 1
        above[many] = self._name(above[many] * (len(symbols) + 1) + size[many])
        self._level(symbols, first, True)
        return above

    def _pairs(self, symbols: np.ndarray, salt: int) -> np.ndarray:
        """Replace pairs of a left and a right symbol; of four partitions the best counts."""
        plain = symbols >= 0
        best = np.zeros(0, dtype=np.int64)
        for k in (2 * salt, 2 * salt + 1):
            side = _side(symbols, k)
            for left, right in ((plain & side, plain & ~side), (plain & ~side, plain & side)):
                heads = np.flatnonzero(left[:-1] & right[1:])
                best = heads if len(heads) > len(best) else best
        if not len(best):
            return symbols
        opens = np.ones(len(symbols), dtype=bool)
        opens[best + 1] = False
        first = np.flatnonzero(opens)
        above = symbols[first].copy()
        # Heads keep their order, so their places above follow from the number of pairs before.
        above[best - np.arange(len(best))] = self._name(symbols[best] * self._next + symbols[best + 1])
        self._level(symbols, np.append(first, len(symbols)), False)
        return above

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """For places a < b: how many symbols from there on agree (``back``: up to there)."""
        at, bt = a.copy(), b.copy()
        off = 1 if back else 0
        stopped: list[list[np.ndarray]] = [[] for _ in self.levels]

        def advance(work: np.ndarray, level: dict) -> np.ndarray:
            """Step over what agrees; gives those that did."""
            x, y = at[work], bt[work]
            same = level["symbol"][x - off] == level["symbol"][y - off]
            work, x, y = work[same], x[same], y[same]
            step = 1
            if level.get("blocks"):  # all symbols up to the nearer end of the two blocks agree
                first, parent = level["first"], level["parent"]
                if back:
                    step = np.minimum(x - first[parent[x - 1]], y - first[parent[y - 1]])
                else:
                    step = np.minimum(first[parent[x] + 1] - x, first[parent[y] + 1] - y)
            at[work] = x - step if back else x + step
            bt[work] = y - step if back else y + step
            return same

        todo = np.arange(len(a))
        for depth, level in enumerate(self.levels[:-1]):
            parent, first = level["parent"], level["first"]
            ready, work = [], todo
            while len(work):
                x, y = at[work], bt[work]
                whole = (first[parent[x]] == x) & (first[parent[y]] == y)
                ready.append(work[whole])
                work = work[~whole]
                same = advance(work, level)
                stopped[depth].append(work[~same])
                work = work[same]
            todo = np.concatenate(ready) if ready else todo
            at[todo], bt[todo] = parent[at[todo]], parent[bt[todo]]
        below = todo
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            below = np.concatenate([below, *stopped[depth]])
            work = below
            while len(work):
                work = work[advance(work, level)]
            if depth:
                first = self.levels[depth - 1]["first"]
                at[below], bt[below] = first[at[below]], first[bt[below]]
        return a - at if back else at - a


# --- runs -----------------------------------------------------------------------


def _candidates(symbols: np.ndarray, reach: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) on the grids.  ``reach[n]``: where the texts of at least n words end."""
    places, periods = [], []
    for period in range(1, longest // MIN_REPEATS + 1):
        step = max(period, GRID)
        end = reach[max(MIN_WORDS, MIN_REPEATS * period)]
        same = symbols[: end - period : step] == symbols[period:end:step]
        found = np.flatnonzero(same[:-1] & same[1:])
        if len(found):
            places.append(found * step)
            periods.append(np.full(len(found), period))
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Per text (word codes >= 0): its runs as rows (start, length, period), by start and period."""
    none = np.zeros((0, 3), dtype=np.int64)
    out = [none] * len(texts)
    order = sorted((i for i, t in enumerate(texts) if len(t) >= MIN_WORDS), key=lambda i: -len(texts[i]))
    if not order:
        return out
    size = np.array([len(texts[i]) for i in order])
    starts = np.cumsum(size + 1) - size  # a separator before each text
    joined = np.empty(int(size.sum()) + len(order) + 1, dtype=np.int64)
    joined[np.append(starts - 1, len(joined) - 1)] = -1 - np.arange(len(order) + 1)
    for i, start in zip(order, starts, strict=True):
        joined[start : start + len(texts[i])] = texts[i]
    longest = int(size[0])
    # Texts fall in length, so those of at least n words are a prefix of ``joined``.
    count = np.searchsorted(-size, -np.arange(longest + 2), side="right")
    reach = np.where(count > 0, (starts + size)[count - 1], 0)
    place, period = _candidates(joined, reach, longest)
    owner = np.searchsorted(starts, place, side="right") - 1
    inside = (owner >= 0) & (place + period < (starts + size)[owner])
    place, period, owner = place[inside], period[inside], owner[inside]
    if not len(place):
        return out
    # The grammar holds the texts that have candidates.
    chosen = np.unique(owner)
    moved = np.zeros(len(order), dtype=np.int64)
    moved[chosen] = np.cumsum(size[chosen] + 1) - size[chosen]
    parts = [joined[starts[o] - 1 : starts[o] + size[o]] for o in chosen]
    grammar = Grammar(np.concatenate([*parts, [-len(order) - 2]]))
    place = place - starts[owner] + moved[owner]
    found = []
    for low in range(0, len(place), _QUERIES):
        x, p, o = place[low : low + _QUERIES], period[low : low + _QUERIES], owner[low : low + _QUERIES]
        before = grammar.extend(x, x + p, back=True)
        length = before + grammar.extend(x, x + p) + p
        long_enough = length >= np.maximum(MIN_WORDS, MIN_REPEATS * p)
        start = (x - before - moved[o])[long_enough]
        found.append(np.unique(np.stack([o[long_enough], start, length[long_enough], p[long_enough]]), axis=1))
    # Multiples of a period find the same stretch; the smallest is the run's.
    owner, start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    first = np.ones(len(owner), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    owner, start, length, period = owner[first], start[first], length[first], period[first]
    by_start = np.lexsort((period, start, owner))
    rows = np.stack([start, length, period], axis=1)[by_start]
    cuts = np.searchsorted(owner[by_start], np.arange(len(order) + 1))
    for o in np.unique(owner):
        out[order[o]] = rows[cuts[o] : cuts[o + 1]]
    return out


def top_run(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length over period; ties go to the smallest start, then period."""
    if not len(runs):
        return None
    ratio = runs[:, 1] / runs[:, 2]
    near = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    return tuple(min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which words no run contains after its first period."""
    depth = np.zeros(count + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth)[:count] == 0


def _rows(texts: list[str | None]) -> Iterator[tuple]:
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    flat = pa.array([w for own in words for w in own], pa.binary()).dictionary_encode().indices.to_numpy()
    ends = np.cumsum([len(own) for own in words])
    codes = np.split(flat.astype(np.int64), ends[:-1])
    for own, runs in zip(words, runs_of(codes), strict=True):
        kept = own
        if len(runs):
            kept = [w for w, keep in zip(own, kept_words(len(own), runs), strict=True) if keep]
        yield len(own), runs, top_run(runs), b" ".join(kept).decode("utf-8", "surrogatepass")


def _struct(rows: np.ndarray) -> pa.StructArray:
    names = ("start", "length", "period")
    return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], names=list(names))


def _batch(keys: pa.Array, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    counts, runs, tops, texts = zip(*rows, strict=True)
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32))
    tops = [None if t is None else dict(zip(("start", "length", "period"), t, strict=True)) for t in tops]
    top = pa.array(tops, pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    spans = pa.ListArray.from_arrays(offsets, _struct(np.concatenate(runs)))
    return pa.RecordBatch.from_arrays([keys, pa.array(counts, pa.int64()), spans, top, pa.array(texts)], names=names)


def find_runs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, runs, top, collapsed) for every row of ``docs`` (key, text).

    Words have no ASCII white space in them.  ``runs`` holds (start, length, period) by
    start, then period, and is empty for a null, empty or short text; ``top`` is null then.
    ``collapsed`` joins by one space the words that no run holds after its first period: of
    each run one period stays.  Repeated rows are judged each by itself, a null key is kept
    and other columns are left out.  No rows give no rows.
    """
    ship_code(docs.sparkSession)
    given = docs.select(key, "text")
    empty = given.select(key, *[F.lit(None).cast(t).alias(n) for n, t in _fields()])
    names = empty.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, low, held = [], 0, 0
            for k, text in enumerate(batch.column(1)):
                text = text.as_py()
                texts.append(text)
                held += len(text or "") // 4
                if held >= CHUNK_WORDS or k + 1 == batch.num_rows:
                    yield _batch(batch.column(0).slice(low, len(texts)), list(_rows(texts)), names)
                    texts, low, held = [], k + 1, 0

    return given.mapInArrow(run, empty.schema)


def _fields() -> list[tuple[str, str]]:
    return [("n_words", "long"), ("runs", f"array<{RUN}>"), ("top", RUN), ("collapsed", "string")]
