import random
import re

from pairmine.llm import linedup

from .helpers import DOCS, odd_docs, with_clashes


def brute(rows):
    """Text and removed lines per row; rows of equal id and text are one document."""
    lines = []
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        for i, line in enumerate((t or "").split("\n")):
            words = re.findall("[^ \t\x0b\x0c\r]+", line)
            if len(words) >= 5:
                lines.append((d, t, i, frozenset(words)))
    gone = set()
    for k, (d, t, i, s) in enumerate(lines):
        if any(9 * len(s & o) >= 4 * (len(s) + len(o)) for _, _, _, o in lines[:k]):
            gone.add((d, t, i))
    out = []
    for d, t in rows:
        kept = [x for i, x in enumerate((t or "").split("\n")) if (d, t, i) not in gone]
        out.append((d, t if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def run(df):
    return sorted([(r.doc_id, r.text) for r in linedup.dedup_lines(df).collect()], key=str)


def test_equals_brute_force(spark):
    chosen = random.Random(2)
    pool = [[f"w{chosen.randrange(60)}" for _ in range(chosen.randint(3, 30))] for _ in range(25)]

    def line():
        words = list(chosen.choice(pool))
        for _ in range(chosen.choice([0, 0, 1, 2, 4])):
            words[chosen.randrange(len(words))] = f"w{chosen.randrange(60)}"
        return " ".join(words)

    rows = [(i, "\n".join(line() for _ in range(chosen.randint(1, 8)))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).repartition(5)
    assert run(df) == brute(rows)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    clashing = with_clashes(docs, "n_lines", "at", "k1", "line")
    assert run(clashing) == brute(rows)
    assert linedup.dedup_lines(docs.limit(0)).count() == 0


def test_stage_keeps_columns_and_drops_what_is_left_empty(spark):
    text = "one line of some words\nanother line of other words"
    docs = spark.createDataFrame([(1, text, "en", "s", 49), (2, text, "en", "s", 49), (3, "", "en", "s", 0)], DOCS)
    kept = linedup.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_lines_on_both_sides_of_the_short_set_bound(spark):
    chosen = random.Random(4)
    size = linedup._SHORT_SET
    base = [f"w{n}" for n in range(size + 30)]
    lines = [base[: size + chosen.randint(-25, 30)] for _ in range(12)]
    for words in lines:
        for _ in range(chosen.choice([0, 3, 12, 40])):
            words[chosen.randrange(len(words))] = f"v{chosen.randrange(10**6)}"
    rows = [(i, " ".join(words)) for i, words in enumerate(lines)]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).repartition(3)
    assert run(df) == brute(rows)


def test_lines_of_few_words_are_compared_too(spark):
    chosen = random.Random(5)
    rows = [
        (i, "\n".join(" ".join(chosen.choice("abcdefg") for _ in range(chosen.randint(0, 6))) for _ in range(6)))
        for i in range(30)
    ]
    rows += [(30, "p q r s"), (31, "p q r s t"), (32, "p  q\tr"), (33, "r q p q"), (34, "没有空格的一行"), (35, "没有空格的一行")]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).repartition(3)
    got = sorted((r.doc_id, r.text) for r in linedup.dedup_lines(df, linedup.ALL_LINES).collect())
    earlier, expected = [], []
    for i, text in rows:
        stay = []
        for line in text.split("\n"):
            words = set(line.split())
            if not words or not any(5 * len(words & o) >= 4 * len(words | o) for o in earlier):
                stay.append(line)
            if words:
                earlier.append(words)
        expected.append((i, "\n".join(stay)))
    assert got == expected


def test_stage_drops_a_copy_with_short_lines(spark):
    text = "A title\none line of some words\nThe end"
    docs = spark.createDataFrame([(1, text, "en", "s", 36), (2, text, "en", "s", 36)], DOCS)
    assert [r.doc_id for r in linedup.drop_repeated_lines(docs).collect()] == [1]


def brute_all(rows):
    """(doc_id, n_lines, n_removed, text) if all lines with a word take part."""
    lines = []
    for d, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        lines += [(d, t, i, frozenset(re.findall("[^ \t\x0b\x0c\r]+", x))) for i, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[3]]
    gone = {x[:3] for k, x in enumerate(lines) if any(9 * len(x[3] & o[3]) >= 4 * (len(x[3]) + len(o[3])) for o in lines[:k])}
    out = []
    for d, t in rows:
        kept = [x for i, x in enumerate((t or "").split("\n")) if (d, t, i) not in gone]
        n = 0 if t is None else t.count("\n") + 1
        out.append((d, n, 0 if t is None else n - len(kept), t if t is None else "\n".join(kept)))
    return sorted(out, key=str)


def run_all(df):
    cleaned = linedup.dedup_lines(df, linedup.ALL_LINES)
    return sorted([(r.doc_id, r.n_lines, r.n_removed, r.text) for r in cleaned.collect()], key=str)


def test_odd_rows_as_the_query_runs(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run_all(with_clashes(docs, "tokens", "items", "place", "all")) == brute_all(rows)
    assert run_all(docs.limit(0)) == []


def near_lines(seed, runs):
    """Lines that differ from one of a few by words at chosen distances, so that common words stand in runs."""
    chosen = random.Random(seed)
    pool = [[f"w{chosen.randrange(10**6)}" for _ in range(chosen.choice([4, 5, 9, 10, 18, 45, 90, 130]))] for _ in range(12)]
    lines = []
    for _ in range(120):
        words = list(chosen.choice(pool))
        for _ in range(chosen.choice(runs)):
            at = chosen.randrange(len(words) + 1)
            words[at : at + chosen.randint(0, 2)] = [f"v{chosen.randrange(10**6)}"] * chosen.randint(0, 1)
        chosen.shuffle(words)
        lines.append(" ".join(words))
    return [(i // 4, "\n".join(lines[i : i + 4])) for i in range(0, len(lines), 4)]


def test_pairs_meet_at_the_first_of_their_common_words(spark):
    for seed, runs in ((6, [0, 1]), (7, [0, 1, 2, 5, 9]), (8, [1, 4, 8, 16])):
        rows = near_lines(seed, runs)
        df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).repartition(3)
        assert run_all(df) == brute_all(rows)


def test_joined_rows_of_facts_as_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr("pairmine.llm.rows.BROADCAST_ROWS", 0)
    rows = near_lines(9, [0, 1, 2, 5]) + [(None, "a b c d e\na b c d"), (None, None), (3, ""), (3, "a b c d e")]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in rows], DOCS).repartition(3)
    assert run_all(df) == brute_all(rows)


def test_a_pair_is_a_row_of_one_word_not_of_each(spark):
    words = [f"w{n}" for n in range(60)]
    lines = [" ".join(words), " ".join(words[:58] + ["x", "y"])]
    df = spark.createDataFrame([(1, "\n".join(lines), "", "", 0)], DOCS)
    described = linedup._sets(linedup._lines(df.select("doc_id", "text"), 1), linedup._rarity(df)).selectExpr(
        "struct(doc_id, rid, line_no) at",
        "size(r) n",
        f"transform(slice(r, 1, {linedup._prefix('size(r)')}), x -> {linedup._SHORT}) p",
        "aggregate(r, 0L, (s, x) -> s ^ shiftleft(1L, cast(x & 63L as int))) s0",
        "0L s1",
    )
    prefixes = [set(r.p) for r in described.collect()]
    shared = linedup._shared(linedup._tokens(described)).collect()
    assert 2 <= len(shared) < 2 * len(prefixes[0] & prefixes[1])


def test_rarity_tells_buckets_of_close_counts_apart():
    counts = [500 + n % 100 for n in range(1000)] + [10**6, 10**7]
    classes = linedup._rank_classes(counts)
    assert len(set(classes[:1000])) > 30
    assert max(classes[:1000]) < classes[1000] < classes[1001] < 32 and min(classes) == -32
    assert all(classes[a] <= classes[b] for a in range(0, 100) for b in range(0, 100) if counts[a] <= counts[b])
