"""Sum-of-squares online packing of token sequences into fixed windows.

Every document becomes its token ids and a closing id.  Full windows are cut off
its front; the rest, shorter than a window, is placed online into the fill level
that keeps the sum of squared counts of partially filled windows smallest.  The
state of a task is one count and one stack of open windows per level; documents never
move: the scan is the only stage.  Rests that fit no other (each longer than half a
window, say) leave a window open each.  When the open windows hold ``OPEN_TOKENS``, and
when the task ends, the pieces of the emptiest are cut to fill the fullest, so a task
holds a bounded number of tokens and pads at most one window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairmine.llm.common import ship_code

CAPACITY = 1024
CLOSING_ID = 0
SCHEMA = (
    "doc_id long, start long, length long, token_ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)
_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("token_ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_BATCH_TOKENS = 1_000_000
#: Tokens that the open windows of a task hold at most.
OPEN_TOKENS = 4_000_000


class Levels:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.held = 0
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.stacks: list[list[list]] = [[] for _ in range(capacity + 1)]

    def choose(self, size: int) -> int:
        """The level whose window takes ``size`` tokens; 0 opens a new one.

        Moving a window from level h to h + size changes the sum of squares by
        2 (N[h + size] - N[h] + 1); a new window changes it by 2 N[size] + 1.  A
        full window counts nothing.  Ties go to the fullest window.
        """
        last = self.capacity - size
        counts = self.counts
        if last <= 0:
            return 0
        levels = np.flatnonzero(counts[1 : last + 1]) + 1
        if not len(levels):
            return 0
        after = levels + size
        change = np.where(after == self.capacity, 1 - 2 * counts[levels], 2 * (counts[after] - counts[levels] + 1))
        best = len(levels) - 1 - int(np.argmin(change[::-1]))
        fresh = 2 * int(counts[size]) + 1
        return 0 if fresh < change[best] else int(levels[best])

    def place(self, piece: tuple, size: int) -> list | None:
        """Put the piece into a window; the window if that filled it."""
        level = self.choose(size)
        if level:
            window = self.stacks[level].pop()
            self.counts[level] -= 1
        else:
            window = []
        window.append(piece)
        if level + size == self.capacity:
            self.held -= level
            return window
        self.held += size
        self.stacks[level + size].append(window)
        self.counts[level + size] += 1
        return None

    def drain(self) -> Iterator[list]:
        """Full windows from what is open: the emptiest fill the fullest.

        One window at most stays open; ``last`` gives it.
        """
        rest = [w for stack in reversed(self.stacks) for w in stack]
        fills = [sum(p[2] for p in w) for w in rest]
        self.counts[:] = 0
        self.stacks = [[] for _ in self.stacks]
        self.held = 0
        low, high = 0, len(rest) - 1
        while low < high:
            room = self.capacity - fills[low]
            while room and low < high:
                doc, start, size, ids, total = rest[high].pop()
                take = min(room, size)
                rest[low].append((doc, start, take, ids[: 4 * take], total))
                if take < size:
                    rest[high].append((doc, start + take, size - take, ids[4 * take :], total))
                fills[high] -= take
                room -= take
                if not rest[high]:
                    high -= 1
            if not room:
                yield rest[low]
                low += 1
        if rest and low <= high and rest[low]:
            fill = sum(p[2] for p in rest[low])
            self.stacks[fill].append(rest[low])
            self.counts[fill] += 1
            self.held = fill

    def last(self) -> list[list]:
        return [w for stack in self.stacks for w in stack]


def _pack(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int):
    from pyspark import TaskContext

    from pairmine.llm.tokens import load_encoder

    encode = load_encoder(vocabulary)
    closing = np.array([CLOSING_ID], dtype="<u4").tobytes()
    levels = Levels(capacity)
    sequence = TaskContext.get().partitionId() << 33
    out: list[tuple] = []
    held = 0

    def emit(window):
        nonlocal sequence, held
        offset = 0
        for doc, start, size, ids, total in window:
            out.append((doc, start, size, ids, total, sequence, offset))
            offset += size
        sequence += 1
        held += offset

    def flush():
        nonlocal held
        columns = list(zip(*out, strict=True)) or [[] for _ in _OUT]
        out.clear()
        held = 0
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT
        )

    def closed():
        for window in levels.drain():
            emit(window)
            if held > _BATCH_TOKENS:
                yield flush()

    for batch in batches:
        ids_of = batch.column(0)
        texts = batch.column(1)
        for doc, text in zip(ids_of, texts, strict=True):
            ids = encode(text.as_py() or "") + closing
            doc = doc.as_py()
            total = len(ids) // 4
            full = total - total % capacity
            for start in range(0, full, capacity):
                emit([(doc, start, capacity, ids[4 * start : 4 * (start + capacity)], total)])
            if full < total:
                filled = levels.place((doc, full, total - full, ids[4 * full :], total), total - full)
                if filled:
                    emit(filled)
            if held > _BATCH_TOKENS:
                yield flush()
            if levels.held > OPEN_TOKENS:
                yield from closed()
    yield from closed()
    for window in levels.last():
        emit(window)
    yield flush()


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) in windows of ``capacity`` tokens.

    ``vocabulary`` is the path of a byte-level BPE file of the ``tokenizers``
    library, present on every machine.  ``token_ids`` holds the ids of the piece as
    little-endian unsigned 32-bit numbers.  Null and empty texts are the closing id
    alone, repeated rows are packed each on its own, a null doc_id stays null, other
    columns are ignored and no rows give no rows.  A document of any length is held
    alone by one task while it is cut.
    """
    ship_code(docs.sparkSession)
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return source.mapInArrow(lambda batches: _pack(batches, vocabulary, capacity), SCHEMA)
