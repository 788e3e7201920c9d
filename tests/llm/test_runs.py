import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairmine.llm import queries, runs

from .helpers import DOCS, odd_docs, with_clashes


def brute(words):
    """Every run, by its definition: per period the maximal stretches, then the smallest period."""
    n, found = len(words), {}
    for p in range(1, n // runs.MIN_REPEATS + 1):
        start = None
        for i in range(n - p + 1):
            same = i < n - p and words[i] == words[i + p]
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + p
                if length >= max(runs.MIN_WORDS, runs.MIN_REPEATS * p):
                    found.setdefault((start, length), p)
                start = None
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def periodic(rng, words):
    """Some stretches made periodic, nested and overlapping ones too."""
    out = list(words)
    for _ in range(rng.randrange(4)):
        if out:
            a, p = rng.randrange(len(out)), rng.randrange(1, 40)
            for i in range(a, min(len(out), a + p * rng.randrange(2, 12) + rng.randrange(6))):
                out[i] = out[a + (i - a) % p]
    return out


@pytest.mark.parametrize("seed", range(25))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randrange(1, 15)):
        size, kinds = rng.choice([0, 1, 23, 24, 25, 71, 200, 400]), rng.choice([1, 2, 3, 8, 60])
        texts.append(periodic(rng, [rng.randrange(kinds) for _ in range(size)]))
    got = runs.runs_of([np.array(t, dtype=np.int64) for t in texts])
    assert [[tuple(r) for r in g.tolist()] for g in got] == [brute(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), min_size=1, max_size=4))
def test_extensions_equal_comparison(texts):
    line = [-1]
    for k, text in enumerate(texts):
        line += [*text, -2 - k]
    grammar = runs.Grammar(np.array(line))
    places = [(i, j) for i in range(1, len(line) - 1) for j in range(i + 1, len(line) - 1)][:400]
    if not places:
        return
    a, b = (np.array(p) for p in zip(*places, strict=True))
    for (i, j), on, back in zip(places, grammar.extend(a, b), grammar.extend(a, b, back=True), strict=True):
        k = 0
        while line[i + k] == line[j + k]:
            k += 1
        m = 0
        while line[i - 1 - m] == line[j - 1 - m]:
            m += 1
        assert (on, back) == (k, m)


def test_long_periodic_text():
    one, many = np.zeros(60_000, dtype=np.int64), np.arange(60_000) % 7
    (a,), (b,) = (r.tolist() for r in runs.runs_of([one, many]))
    assert a == [0, 60_000, 1] and b == [0, 60_000, 7]


def test_top_and_kept():
    rows = np.array([[0, 24, 8], [30, 30, 10], [90, 27, 9]])
    assert runs.top_run(rows) == (0, 24, 8)
    assert runs.top_run(np.array([[0, 24, 8], [40, 301, 100]])) == (40, 301, 100)
    assert runs.top_run(rows[:0]) is None
    assert np.flatnonzero(~runs.kept_words(40, rows[:1])).tolist() == list(range(8, 24))


def test_rows(spark):
    loop = "a b c d " * 10
    rows = [(100, f"x {loop}y", "", "", 0), (101, loop, "", "", 0), (101, loop, "", "", 0)]
    docs = with_clashes(odd_docs(spark).union(spark.createDataFrame(rows, DOCS)), "runs", "top", "n_words", "collapsed")
    found = runs.find_runs(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found}
    assert [tuple(r) for r in by_id[100].runs] == [(1, 40, 4)] == [tuple(by_id[100].top)]
    assert by_id[100].collapsed == "x a b c d y" and by_id[101].collapsed == "a b c d"
    assert by_id[0].n_words == 0 and by_id[0].runs == [] and by_id[0].top is None and by_id[0].collapsed == ""
    given = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        own = (given[r.doc_id] or "").encode().split()
        assert [tuple(x) for x in r.runs] == (brute(own) if len(own) < 2_000 else [])
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_query_repeats_words(spark, tmp_path):
    import zlib

    rows = [(i, " ".join(f"w{i}x{k}" for k in range(50)), "", "", 0) for i in range(60)]
    rows += [(None, "a b", "", "", 0), (7, None, "", "", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert len(found) == 62
    for r in found:
        if r.doc_id is None or r.n_runs == 0:
            continue
        h = zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        assert h % 10 == 0
        a = g % 50
        p = 1 + (50 - a) // (3 + g % 8)
        assert (r.start, r.length, r.period) == (a, 50 - a, p)
        assert r.exponent_milli == 1000 * (50 - a) // p
    assert any(r.n_runs for r in found)
