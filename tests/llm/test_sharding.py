import collections
import zlib

import numpy as np
import pytest

from pairmine.llm import sharding

from .helpers import DOCS, odd_docs, with_clashes


def check(rows, texts, shards):
    slots, where = collections.defaultdict(list), {}
    for r in rows:
        text = texts[(r.doc_id, r.text_crc32)]
        raw = (text or "").encode()
        assert r.size == len(raw) + 16
        slots[r.shard].append(r.slot)
        assert where.setdefault(raw, r.shard) == r.shard
        assert 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def keyed(docs):
    return {(r.doc_id, zlib.crc32((r.text or "").encode())): r.text for r in docs.collect()}


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "size", "shard", "digest", "bucket")
    rows = sharding.shard(docs, 4).collect()
    assert len(rows) == docs.count()
    check(rows, keyed(docs), 4)
    assert sharding.shard(docs.limit(0), 4).count() == 0


# Parts of a handful of groups a shard cannot level out as finely as real ones.
@pytest.mark.parametrize("part,share", [(4_096, 0.005), (40, 0.02)])
def test_sums_are_close(spark, monkeypatch, part, share):
    monkeypatch.setattr(sharding, "PART_GROUPS", part)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 7)
    random = np.random.default_rng(3)
    sizes = np.exp(random.normal(6, 1, 500)).astype(int)
    rows = [(i, f"{i} " + "x" * int(n), "", "", 0) for i, n in enumerate(sizes)]
    rows += [(1000 + i, rows[i % 30][1], "", "", 0) for i in range(90)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sharding.shard(docs, 8).collect()
    check(found, keyed(docs), 8)
    sums = collections.Counter()
    for r in found:
        sums[r.shard] += r.size
    assert len(sums) == 8 and max(sums.values()) - min(sums.values()) < share * sum(sums.values()) / 8


def test_a_group_above_its_share_stands_alone(spark):
    rows = [(i, "copy " * 100, "", "", 0) for i in range(400)] + [(1000 + i, f"{i} text", "", "", 0) for i in range(900)]
    found = sharding.shard(spark.createDataFrame(rows, DOCS), 8).collect()
    sums, large = collections.Counter(), {r.shard for r in found if r.size > 400}
    for r in found:
        sums[r.shard] += r.size
    assert len(large) == 1 and sums[large.pop()] == 400 * 516
    others = sorted(sums.values())[:-1]
    assert others[-1] - others[0] < 40


def test_differencing():
    sums = np.zeros((5, 2), dtype=np.int64)
    sums[:, 0] = [8, 7, 6, 5, 4]
    dealt = sharding.difference(sums)
    totals = [int(sum(sums[i, s] for i in range(5) for s in range(2) if dealt[i, s] == k)) for k in range(2)]
    assert sorted(totals) == [14, 16]
    assert all(sorted(row) == [0, 1] for row in dealt)
