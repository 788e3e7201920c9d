import collections
import random

import pytest

from pairmine.llm import mixing

from .helpers import DOCS, odd_docs, with_clashes


def targets_of(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Shares by weight; what is above a source's limit is shared again until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = {}, share * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        among = sum(weight[s] for s in rest)
        part = {s: left * weight[s] / among for s in rest}
        above = [s for s in rest if part[s] > most * sizes[s]]
        if not above:
            return {**full, **part}
        full |= {s: most * sizes[s] for s in above}


def check(rows, sizes):
    want = targets_of(sizes)
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        copies = max(collections.Counter((r.doc_id, r.size) for r in rows if r.source == source).values())
        assert abs(taken[source] - target) <= copies


def mixed(docs, **more):
    """The rows of ``mix``, with the source that the id stands for."""
    from pyspark.sql import functions as F

    sources = docs.select("doc_id", "source").distinct()
    found = mixing.mix(docs, **more)
    return found.join(sources, found["doc_id"].eqNullSafe(sources["doc_id"])).select(found["*"], F.col("source")).collect()


def corpus(spark, seed, count, sources=("a", "b", "c", None)):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = rng.choices(sources, [6, 1, 2, 3][: len(sources)])[0]
        rows.append((i, " ".join("w" * rng.choice([0, 1, 5, 30, 200])) or None, "en", source, 0))
    return spark.createDataFrame(rows, DOCS), rows


def sizes_of(rows):
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    return sizes


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_met(spark, seed):
    docs, rows = corpus(spark, seed, 400)
    found = mixed(docs)
    assert len(found) == 400
    check(found, sizes_of(rows))
    again = mixed(docs.repartition(5))
    assert sorted(found, key=str) == sorted(again, key=str)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 10}, {"a": 5}, {"a": 0, "b": 7}, {"a": 1000, "b": 1, None: 3}])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert found == pytest.approx(targets_of(sizes))
    with pytest.raises(ValueError):
        mixing.source_targets(table, share=2.5)


def test_epochs_come_before_the_sample(spark):
    docs, _ = corpus(spark, 9, 300)
    for r in mixed(docs):
        whole = r.target // r.source_size
        assert whole * r.size <= r.taken <= (whole + 1) * r.size


def test_weights_decide_who_is_drawn(spark):
    rows = [(i, "w " * 10, "en", "b" if i < 2000 else "a", 0) for i in range(2500)]
    docs = spark.createDataFrame(rows, DOCS)
    liked = spark.createDataFrame([(i, 1 if i % 2 else 0, 0) for i in range(2500)], "doc_id long, quality int, toxic int")
    found = mixing.mix(docs, mixing.quality_weights(liked)).collect()
    some = [r for r in found if r.doc_id < 2000]
    partly = {r.doc_id % 2: 0 for r in some}
    for r in some:
        partly[r.doc_id % 2] += r.taken > r.size * (r.target // r.source_size)
    assert partly[1] > 1.5 * partly[0] > 0


def test_copies_share_alike(spark):
    rows = [(5, "a b c d", "en", "x", 0)] * 500 + [(i, "p q", "en", "x", 0) for i in range(100, 200)]
    rows += [(i, "r s t", "en", "y", 0) for i in range(1000, 2000)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixed(docs)
    assert len({r.taken for r in found if r.doc_id == 5}) == 1
    check(found, sizes_of(rows))


def test_odd_rows(spark):
    docs = with_clashes(odd_docs(spark), "size", "target", "bucket", "draw", "weight", "name")
    found = mixing.mix(docs).collect()
    given = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    assert len(found) == len(given)
    assert sum(r.size for r in found) == sum(sizes_of(given).values())
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    assert sum(r.taken for r in found) == pytest.approx(1.5 * sum(r.size for r in found), abs=6)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert [r.taken for r in mixing.mix(docs.filter("text is null")).collect()] == [0, 0]
