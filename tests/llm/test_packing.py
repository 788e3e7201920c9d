import collections
import random
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pairmine.llm import packing, tokens  # noqa: E402
from pairmine.llm.queries import vocabulary_path  # noqa: E402

from .helpers import DOCS, odd_docs, odd_texts, with_clashes  # noqa: E402


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def ids_of(whole, text):
    return np.array(whole.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


ODD = [
    "", " ", "   ", "\n", "a", "  a", "a  b", "a \n b", "a\n ", "a \n", "\n a\n\n  b ", "x <|endoftext|> y",
    "a\x1c b", "a \x85b c", "ａ１ ² x½", "don't  stop", "a　 b", "a  b", "a\t b \tc", "🙂 🙂🙂  x",
]


@pytest.mark.parametrize("text", ODD)
def test_ids_equal_those_of_the_library(whole, text):
    assert tokens.load_encoder(vocabulary_path())(text) == ids_of(whole, text).tobytes()


def test_ids_of_random_texts(whole):
    chosen = random.Random(3)
    encode = tokens.load_encoder(vocabulary_path())
    for _ in range(300):
        text = "".join(chosen.choice("ab1²'  \n\t\x1c é🙂.,<|>") for _ in range(40))
        assert encode(text) == ids_of(whole, text).tobytes()


def check_pieces(rows, whole, texts, capacity):
    windows = collections.defaultdict(list)
    pieces = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append((r.start, r.length, bytes(r.token_ids), r.doc_tokens))
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    for doc, text in texts.items():
        want = ids_of(whole, text).tobytes() + b"\0\0\0\0"
        parts = sorted(pieces[doc])
        assert b"".join(p[2] for p in parts) == want
        assert all(p[3] * 4 == len(want) for p in parts)
    return windows


def test_every_id_lies_in_one_piece(spark, whole):
    texts = dict(enumerate(odd_texts()))
    docs = with_clashes(spark.createDataFrame([(i, t, "", "", 0) for i, t in texts.items()], DOCS), "sequence_id", "start")
    rows = packing.pack(docs, vocabulary_path(), 64).collect()
    windows = check_pieces(rows, whole, texts, 64)
    filled = sum(r.length for r in rows)
    parts = docs.rdd.getNumPartitions()
    assert len(windows) <= filled // 64 + parts


def test_repeated_rows_and_null_ids_are_packed_each(spark):
    rows = packing.pack(odd_docs(spark), vocabulary_path()).collect()
    assert sum(r.doc_id == 5 and r.start == 0 for r in rows) == 3
    assert sum(r.doc_id is None and r.start == 0 for r in rows) == 2


def test_no_rows(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), vocabulary_path()).count() == 0


def test_choice_is_the_least_sum_of_squares():
    chosen = random.Random(5)
    levels = packing.Levels(20)
    for n in range(300):
        size = chosen.randint(1, 19)
        counts = levels.counts.copy()

        def squares(level, counts=counts, size=size):
            after = counts.copy()
            after[level] -= bool(level)
            if level + size < 20:
                after[level + size] += 1
            return int((after[1:20] ** 2).sum())

        options = [0] + [h for h in range(1, 20 - size + 1) if counts[h]]
        assert squares(levels.choose(size)) == min(map(squares, options))
        levels.place((n, 0, size, b"\0" * 4 * size, size), size)


def test_rests_that_fit_no_other_are_closed_in_time(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "OPEN_TOKENS", 2_000)
    monkeypatch.setattr(packing, "_BATCH_TOKENS", 1_000)
    most, place = [], packing.Levels.place

    def watched(levels, piece, size):
        out = place(levels, piece, size)
        most.append((levels.held, sum(p[2] for stack in levels.stacks for w in stack for p in w)))
        return out

    monkeypatch.setattr(packing.Levels, "place", watched)
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    texts = {i: "word " * 43 for i in range(400)}
    batch = pa.RecordBatch.from_pydict({"doc_id": list(texts), "text": list(texts.values())})
    batches = list(packing._pack(iter([batch]), vocabulary_path(), 64))
    rows = [types.SimpleNamespace(**r) for b in batches for r in b.to_pylist()]
    windows = check_pieces(rows, whole, texts, 64)
    assert all(held == open_ for held, open_ in most) and max(held for held, _ in most) <= 2_064
    assert max(sum(b.column("length").to_pylist()) for b in batches) <= 1_128
    assert len(windows) == -(-sum(r.length for r in rows) // 64)


def test_query_digest(spark):
    assert zlib.crc32(np.array([0], "<u4").tobytes()) == 558161692
