"""Weighted acyclic automata over words, three words deep, as arrays.

A transducer maps phrases of one to three words to counts: a path spells the phrase, and
its last transition carries the count (0: no such phrase).  Equal states are one state.
They are built from sorted phrases, deepest level first: a state is complete when
its last phrase has passed and is then looked up among those already registered.

``Phrases`` holds sorted words (bytes) and, for each length, columns of word numbers, the
phrases in order, and their counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEPTH = 3
_PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _numbers(values=()) -> np.ndarray:
    return np.asarray(values, dtype=np.int64)


@dataclass
class Phrases:
    words: pa.BinaryArray
    #: Per length: the columns of word numbers, then the counts.
    columns: list[list[np.ndarray]]

    def select(self, masks: list[np.ndarray]) -> Phrases:
        """The phrases that ``masks`` (one per length) chooses, over the words they use."""
        chosen = [[c[m] for c in own] for own, m in zip(self.columns, masks, strict=True)]
        used = np.unique(np.concatenate([_numbers(), *[c for own in chosen for c in own[:-1]]]))
        columns = [[*[np.searchsorted(used, c) for c in own[:-1]], own[-1]] for own in chosen]
        return Phrases(self.words.take(pa.array(used)), columns)


def keys(columns: list[np.ndarray], words: int) -> np.ndarray:
    """One integer per phrase of up to two words, in the order of the phrases."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = key * words + c
    return key


def summed(columns: list[np.ndarray], counts: np.ndarray, words: int, merge=np.add) -> list[np.ndarray]:
    """Sorted distinct phrases and their merged counts."""
    if not len(counts):
        return [*[_numbers() for _ in columns], _numbers()]
    if words ** len(columns) < 1 << 62:
        key = keys(columns, words)
    else:  # number the first two words first
        key = np.unique(keys(columns[:-1], words), return_inverse=True)[1] * words + columns[-1]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(first)
    return [*[c[order[at]] for c in columns], merge.reduceat(counts[order], at)]


def merge_words(parts: list[pa.Array]) -> tuple[pa.BinaryArray, list[np.ndarray]]:
    """The sorted union of the words, and per part the new numbers of its words."""
    joined = pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
    coded = joined.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    numbers = rank[coded.indices.to_numpy(zero_copy_only=False)] if len(joined) else _numbers()
    cuts = np.cumsum([len(p) for p in parts])[:-1] if parts else []
    return coded.dictionary.take(pa.array(order)), np.split(numbers, cuts) if parts else []


def _share(sizes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For groups of transitions: the state of each, and the group that stands for each state."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(starts, sizes)
    mixed = (place.astype(np.uint64) + _PRIMES[0]) * _PRIMES[1]
    for c, prime in zip(columns, _PRIMES[1:], strict=False):
        mixed = (mixed ^ (mixed >> np.uint64(31))) * prime + c.astype(np.uint64) * _PRIMES[0]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _PRIMES[3]
    running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed)])
    sign = (running[ends] - running[starts]) ^ (sizes.astype(np.uint64) * _PRIMES[2])
    _, first, inverse = np.unique(sign, return_index=True, return_inverse=True)
    stands = first[inverse]
    # Equal signs are compared; a state that only looks equal stands for itself.
    same = sizes == sizes[stands]
    reading = np.flatnonzero(np.repeat(same, sizes))
    other = np.repeat(starts[stands], sizes)[reading] + place[reading]
    unlike = np.zeros(len(reading), dtype=bool)
    for c in columns:
        unlike |= c[reading] != c[other]
    same[np.repeat(np.arange(len(sizes)), sizes)[reading[unlike]]] = False
    stands = np.where(same, stands, np.arange(len(sizes)))
    kept = np.flatnonzero(stands == np.arange(len(sizes)))
    return np.searchsorted(kept, stands), kept


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Transducer:
    words: pa.BinaryArray
    #: Per level the transitions: word, count, state below (not at the last level).
    levels: list[list[np.ndarray]]
    #: Per level below the root: transitions of each state.
    sizes: list[np.ndarray]

    @classmethod
    def build(cls, phrases: Phrases) -> Transducer:
        """From sorted distinct phrases."""
        words = max(1, len(phrases.words))
        one, two, three = (list(c) for c in phrases.columns)

        def with_prefixes(shorter: list[np.ndarray], longer: list[np.ndarray]) -> list[np.ndarray]:
            """``shorter`` and, with count 0, what ``longer`` continues and it lacks."""
            counts = np.concatenate([shorter[-1], np.zeros(len(longer[-1]), dtype=np.int64)])
            columns = [np.concatenate(c) for c in zip(shorter[:-1], longer[:-2], strict=True)]
            return summed(columns, counts, words)

        two = with_prefixes(two, three)
        one = with_prefixes(one, two)
        levels, sizes, below = [three[-2:]], [], None
        for upper, lower in ((two, three), (one, two)):
            heads = keys(upper[:-1], words)
            tails = keys(lower[:-2], words)
            size = np.searchsorted(tails, heads, "right") - np.searchsorted(tails, heads, "left")
            state, kept = _share(size, levels[0] if below is None else [*lower[-2:], below])
            rows = _spans((np.cumsum(size) - size)[kept], size[kept])
            levels[0] = [c[rows] for c in levels[0]]
            sizes.insert(0, size[kept])
            levels.insert(0, [upper[-2], upper[-1], state])
            below = state
        return cls(phrases.words, levels, sizes)

    def phrases(self) -> Phrases:
        """All phrases with a count, in order."""
        word, count, state = self.levels[0]
        prefix, columns = [word], []
        for k in range(DEPTH):
            real = count > 0
            columns.append([*[c[real] for c in prefix], count[real]])
            if k + 1 == DEPTH:
                break
            starts = np.cumsum(self.sizes[k]) - self.sizes[k]
            size = self.sizes[k][state]
            rows = _spans(starts[state], size)
            prefix = [*[np.repeat(c, size) for c in prefix], self.levels[k + 1][0][rows]]
            count = self.levels[k + 1][1][rows]
            state = self.levels[k + 1][2][rows] if k + 2 < DEPTH else None
        return Phrases(self.words, columns)

    def compose(self, asked: Phrases) -> list[np.ndarray]:
        """Per length the counts of the asked phrases; 0 for those that no path spells.

        The phrases and this transducer are walked together, word by word, from the root.
        """
        words = max(1, len(self.words))
        number = pc.index_in(asked.words, self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        out = []
        tables = []
        for k in range(DEPTH):
            owner = np.repeat(np.arange(len(self.sizes[k - 1])), self.sizes[k - 1]) if k else 0
            tables.append(owner * words + self.levels[k][0])
        for length, columns in enumerate(asked.columns, 1):
            state = np.zeros(len(columns[-1]), dtype=np.int64)
            found = np.ones(len(columns[-1]), dtype=bool)
            count = np.zeros(len(columns[-1]), dtype=np.int64)
            for k in range(length):
                own = number[columns[k]].astype(np.int64)
                key = state * words + own
                place = np.searchsorted(tables[k], key)
                place[place == len(tables[k])] = 0
                found = found & (own >= 0) & (tables[k][place] == key) if len(tables[k]) else np.zeros_like(found)
                place = place[found]
                count[:], state[:] = 0, 0
                count[found] = self.levels[k][1][place]
                if k + 1 < DEPTH:
                    state[found] = self.levels[k][2][place]
            out.append(count)
        return out

    def to_bytes(self) -> bytes:
        lengths = pc.binary_length(self.words).to_numpy(zero_copy_only=False)
        plain = b"".join(self.words.to_pylist())
        arrays = [lengths, *[c for level in self.levels for c in level], *self.sizes]
        head, body = [], []
        for a in arrays:
            width = next(w for w in (1, 2, 4, 8) if w == 8 or int(a.max(initial=0)) < 1 << 8 * w)
            head += [len(a), width]
            # Bytes of one place together compress better.
            body.append(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())
        packed = pa.compress(b"".join([*body, plain]), codec="zstd", asbytes=True)
        total = sum(map(len, body)) + len(plain)
        return np.array([total, *head], dtype="<i8").tobytes() + packed

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        arrays_in = 1 + 3 * DEPTH - 1 + DEPTH - 1
        head = np.frombuffer(data, dtype="<i8", count=1 + 2 * arrays_in)
        raw = pa.decompress(data[head.nbytes :], decompressed_size=int(head[0]), codec="zstd", asbytes=True)
        at, arrays = 0, []
        for count, width in head[1:].reshape(-1, 2).tolist():
            planes = np.frombuffer(raw, dtype=np.uint8, count=count * width, offset=at).reshape(width, -1)
            arrays.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64))
            at += count * width
        ends = np.concatenate([[0], np.cumsum(arrays[0])]).astype(np.int32)
        words = pa.Array.from_buffers(
            pa.binary(), len(arrays[0]), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw[at:])]
        )
        levels = [arrays[1:4], arrays[4:7], arrays[7:9]]
        return cls(words, levels, arrays[9:])


def union(parts: list[Transducer], merge=np.add) -> Phrases:
    """All phrases of the transducers; the counts of one phrase are merged."""
    words, numbers = merge_words([p.words for p in parts])
    own = [p.phrases().columns for p in parts]
    columns = []
    for k in range(DEPTH):
        spelled = [
            np.concatenate([_numbers(), *[new[o[k][c]] for o, new in zip(own, numbers, strict=True)]])
            for c in range(k + 1)
        ]
        counts = np.concatenate([_numbers(), *[o[k][-1] for o in own]])
        columns.append(summed(spelled, counts, max(1, len(words)), merge))
    return Phrases(words, columns)
