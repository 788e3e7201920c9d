import random

import numpy as np
import pytest

from pairmine.llm import decontaminate as d

from .helpers import DOCS, odd_docs, with_clashes


def brute(items, words, window=10):
    hit, names = np.zeros(len(words), dtype=bool), set()
    for item, parts in items:
        size = min(window, len(parts))
        for a in range(len(parts) - size + 1 if size else 0):
            for b in range(len(words) - size + 1):
                if words[b : b + size] == parts[a : a + size]:
                    hit[b : b + size] = True
                    names.add(item)
    return hit, names


@pytest.mark.parametrize("seed", range(12))
def test_search_equals_brute_force(seed):
    chosen = random.Random(seed)
    alphabet = [bytes([c]) for c in b"abcd"]
    items = [(f"i{k}", [chosen.choice(alphabet) for _ in range(chosen.randint(0, 14))]) for k in range(8)]
    texts = [[chosen.choice(alphabet) for _ in range(chosen.randint(0, 1500))] for _ in range(4)]
    texts.append(items[0][1] + [b"z"] + items[1][1])
    masks, found = d.Patterns(items, 5).search(texts)
    for words, mask, names in zip(texts, masks, found, strict=True):
        want, who = brute(items, words, 5)
        assert (mask == want).all() and names == who


def test_words():
    assert d.split_words("Ab-C1 é_x—y\x7fz") == [b"ab", b"c1", "é".encode(), "x—y".encode(), b"z"]
    assert d.split_words(None) == []


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, hits string")


def test_passes_of_bounded_size_give_the_same(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(1, f"x {passage[:90]} y", "", "", 0), (2, "clean text", "", "", 0), (3, passage.upper(), "", "", 0)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS), "items", "N_WORDS")
    items = [(7, passage, ""), (9, "clean", ""), (None, "text", ""), (11, None, ""), (12, "--", "")]
    one = d.find_contamination(docs, bench(spark, items)).orderBy("doc_id").collect()
    many = d.find_contamination(docs, bench(spark, items), max_windows=3).orderBy("doc_id").collect()
    assert [(r.hits, r["items"]) for r in one] == [(r.hits, r["items"]) for r in many]
    assert one[0]["items"] == ["7"] and one[1]["items"] == ["9"] and one[1].hits == [0, 2]
    assert one[2].hits == [0, 40]


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark)
    items = bench(spark, [(1, "a b c d", "")])
    found = {(r.doc_id, r.n_words, len(r.hits)) for r in d.find_contamination(docs, items).collect()}
    assert (0, 0, 0) in found and (5, 4, 2) in found
    assert d.find_contamination(docs, items.limit(0)).filter("size(hits) > 0").count() == 0
    assert d.find_contamination(docs.limit(0), items, keep_text=False).columns[-1] == "items"
    assert d.find_contamination(docs, items.limit(0), keep_text=False).count() == docs.count()
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
