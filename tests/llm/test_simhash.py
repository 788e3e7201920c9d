import random

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")
from pairmine.llm import simhash  # noqa: E402
from pairmine.llm.components import components  # noqa: E402

from .helpers import DOCS, odd_docs, with_clashes  # noqa: E402


def brute_fingerprint(text):
    words = (text or "").encode().lower().split() if (text or "").isascii() else None
    if words is None:
        words = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    spans = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(codes):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {c: find(c) for c in codes}


def near(seed, centres, each):
    chosen = random.Random(seed)
    out = set()
    for _ in range(centres):
        code = chosen.getrandbits(64)
        for _ in range(each):
            out.add(code)
            for _ in range(chosen.randint(1, 4)):
                code ^= 1 << chosen.randrange(64)
    return sorted(out)


def signed(code):
    return code - (1 << 64) if code >> 63 else code


@pytest.mark.parametrize("blocks,max_group", [(4, 100_000), (5, 100_000), (4, 6)])
def test_links_join_all_near_codes(spark, blocks, max_group):
    codes = near(4, 30, 12) + list(range(40))
    df = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    links = simhash.fingerprint_links(df, blocks=blocks, max_group=max_group).collect()
    root = {signed(c): signed(c) for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for r in links:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 60
        root[find(r.a)] = find(r.b)
    want = brute_classes(codes)
    groups = {}
    for c in codes:
        groups.setdefault(want[c], set()).add(find(signed(c)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_fingerprints():
    texts = [None, "", "A b", "One two three four five", "É x y Z w " * 50, "a b c\x0bd e"]
    got = simhash.fingerprints([simhash.shingle_hashes(t) for t in texts])
    assert [int(g) for g in got] == [brute_fingerprint(t) for t in texts]


def test_gray_rank_is_the_inverse_of_the_gray_code():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ (ranks >> np.uint64(1))) == ranks).all()


def test_component_is_the_smallest_id(spark):
    docs = with_clashes(odd_docs(spark), "fingerprint", "component_id", "fp", "class")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {}
    classes = brute_classes([brute_fingerprint(t) for _, t in rows])
    for d, t in rows:
        if d is not None:
            c = classes[brute_fingerprint(t)]
            want[c] = min(want.get(c, d), d)
    expected = sorted((d, brute_fingerprint(t), want.get(classes[brute_fingerprint(t)])) for d, t in rows if d is not None)
    got = simhash.near_duplicates(docs).filter("doc_id is not null").collect()
    assert sorted((r.doc_id, r.fingerprint & (1 << 64) - 1, r.component_id) for r in got) == expected
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_first(docs)
    codes = {brute_fingerprint(r.text) for r in docs.collect()}
    assert kept.columns == docs.columns
    assert kept.count() == len(set(brute_classes(list(codes)).values()))


def test_components(spark):
    chosen = random.Random(1)
    links = [(k, k + 1) for k in range(0, 200)] + [(chosen.randrange(300, 600), chosen.randrange(300, 600)) for _ in range(150)]
    links += [(900, k) for k in range(901, 1000)] + [(5, 5), (2000, 2000), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for pair in links if None not in pair for n in pair}
    for _ in range(400):
        for a, b in links:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
