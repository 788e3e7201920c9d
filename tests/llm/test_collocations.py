import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pairmine.llm import collocations
from pairmine.llm.transducers import Phrases, Transducer, union

from .helpers import DOCS, odd_docs, odd_texts, with_clashes


def phrases(counts):
    """``Phrases`` of a dictionary from tuples of words to counts."""
    words = sorted({w for p in counts for w in p})
    columns = []
    for k in (1, 2, 3):
        own = sorted(p for p in counts if len(p) == k)
        spelled = [np.array([words.index(p[j]) for p in own], dtype=np.int64) for j in range(k)]
        columns.append([*spelled, np.array([counts[p] for p in own], dtype=np.int64)])
    return Phrases(pa.array(words, pa.binary()), columns)


def counts_of(found):
    words = found.words.to_pylist()
    return {
        tuple(words[i] for i in row[:-1]): row[-1]
        for own in found.columns
        for row in zip(*(c.tolist() for c in own), strict=True)
    }


def some(rng, size):
    def word():
        return bytes([rng.choice(b"abcd")]) * rng.randrange(1, 3)

    return {tuple(word() for _ in range(rng.randrange(1, 4))): rng.choice([1, 1, 300, 1 << 40]) for _ in range(size)}


@pytest.mark.parametrize("seed", range(20))
def test_automata(seed):
    rng = random.Random(seed)
    given = [some(rng, rng.choice([0, 1, 5, 80])) for _ in range(rng.randrange(1, 5))]
    built = [Transducer.from_bytes(Transducer.build(phrases(g)).to_bytes()) for g in given]
    assert [counts_of(b.phrases()) for b in built] == given
    whole = collections.Counter()
    for g in given:
        whole.update(g)
    assert counts_of(union(built)) == dict(whole)
    largest = {p: max(g.get(p, 0) for g in given) for p in whole}
    assert counts_of(union(built, np.maximum)) == largest
    asked = phrases(some(rng, 40) | {(b"zz",): 1})
    answers = counts_of(Phrases(asked.words, [[*c[:-1], f] for c, f in zip(asked.columns, built[0].compose(asked))]))
    assert answers == {p: given[0].get(p, 0) for p in answers} and len(answers) >= 20


def test_equal_states_are_one():
    counts = {(a, b, c): 1 for a in (b"p", b"q", b"r") for b in (b"x", b"y") for c in (b"1", b"2")}
    counts |= {p[:2]: 2 for p in counts} | {p[:1]: 4 for p in counts}
    built = Transducer.build(phrases(counts))
    assert [len(s) for s in built.sizes] == [1, 1] and [len(level[0]) for level in built.levels] == [3, 2, 2]


def brute(rows, least, inside=(50, 100)):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        scored = []
        for p, a in own.items():
            if len(p) == 1 or a < least:
                continue
            longer = [own[q] for q in own if len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and own[q] >= least]
            if any(inside[1] * x >= inside[0] * a for x in longer):
                continue
            cuts = [(1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored), 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def sample(seed, count):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        line = []
        for _ in range(rng.randrange(80)):
            line.append(rng.choice(["New", "york", "city", "of", "the", "é", "ß\x01", "a", "a\x01", "b"]))
            line.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", " "]))
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(line)))
    return rows


@pytest.mark.parametrize("words,most", [(500_000, 4_096), (40, 4_096), (40, 2)])
def test_equal_to_brute_force(spark, monkeypatch, words, most):
    monkeypatch.setattr(collocations, "RANGE_WORDS", words)
    monkeypatch.setattr(collocations, "MAX_RANGES", most)
    rows = sample(words + most, 120)
    docs = spark.createDataFrame([(1, t, lang, "s", 0) for lang, t in rows], DOCS)
    found = collocations.collocations(docs.repartition(7), least=3).collect()
    assert sorted(tuple(r) for r in found) == sorted(brute(rows, 3))
    few = collocations.collocations(docs.coalesce(1), top=5, least=3).collect()
    assert sorted(tuple(r) for r in few) == sorted(r for r in brute(rows, 3) if r[1] <= 5)


def test_a_third_of_all_pairs_is_one(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_WORDS", 300)
    rng = random.Random(4)
    rows = [("en", " ".join(["hot pair"] * 10 + [f"w{rng.randrange(30)}" for _ in range(20)])) for _ in range(60)]
    docs = spark.createDataFrame([(1, t, lang, "s", 0) for lang, t in rows], DOCS)
    found = collocations.collocations(docs).collect()
    assert sorted(tuple(r) for r in found) == sorted(brute(rows, 10))


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "rank", "phrase", "part", "kind", "data", "score")
    given = [(r.lang, r.text) for r in docs.collect() if len(r.text or "") < 10_000]
    short = docs.filter("text is null or length(text) < 10000")
    found = collocations.collocations(short, least=2).collect()
    assert sorted(tuple(r) for r in found) == sorted(brute(given, 2))
    whole = collocations.collocations(docs, least=2).filter("lang = 'en'").agg({"n": "max"}).first()[0]
    assert whole == sum(len(re.findall(r"[^ \t\n\r]+", t or "")) for t in odd_texts()) + 2 * 4
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.filter("text is null")).count() == 0


def test_long_texts_come_in_blocks(monkeypatch):
    monkeypatch.setattr(collocations, "_BLOCK_BYTES", 50)
    texts = ["one two. three", "x" * 200 + " y, " + "z " * 90, ""]
    blocks = list(collocations.tokens(texts))
    assert len(blocks) > 2
    words = [w for block in blocks for w in block if w and w != b"\xff"]
    assert words == b"one two three".split() + [b"x" * 200, b"y"] + [b"z"] * 90
