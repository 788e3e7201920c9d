import collections
import random
import re

from pairmine.llm import rules

from .helpers import DOCS, odd_docs, with_clashes


def base(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    out = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
    return out, n < 50 or 100 * len(covered) > 50 * n, len(lines)


def brute(rows):
    """Verdicts from exact bucket counts."""
    measured = []
    for _, text, lang, source, _ in rows:
        (n, chars, symbols, dup, repeat), failed, lines = base(text)
        values = (min(symbols * 1000 // max(n, 1), 10000), dup * 1000 // max(lines, 1), repeat * 1000 // max(n, 1), min(chars * 16 // max(n, 1), 10000))
        measured.append((lang, source, values, failed))
    kept = []
    for lang, source, values, failed in measured:
        group = [m for m in measured if m[:2] == (lang, source)]
        if len(group) < rules.MIN_GROUP:
            group = [m for m in measured if m[0] == lang]
        if len(group) < rules.MIN_GROUP:
            group = measured
        ok = not failed
        for k, margin in enumerate(rules.MARGINS.values()):
            ordered = sorted(m[2][k] for m in group)
            q1, q3 = ordered[-(-len(ordered) // 4) - 1], ordered[-(-3 * len(ordered) // 4) - 1]
            ok = ok and values[k] <= q3 + max(rules.FENCE * (q3 - q1), margin)
        kept.append(ok)
    return kept


def rows_of(seed, count):
    chosen = random.Random(seed)
    rows = []
    for i in range(count):
        words = [f"{'x' * chosen.randint(1, 6)}{chosen.randrange(40)}" for _ in range(chosen.randint(40, 120))]
        if i % 11 == 0:
            words = [w + "###" for w in words]
        if i % 13 == 0:
            words = words[:9] * 9
        breaks = [" ", " ", "\n", "  ", "\t\n "]
        text = "".join(w + chosen.choice(breaks) for w in words) * chosen.choice([1, 1, 1, 2])
        rows.append((i, chosen.choice(["", " ", "\n"]) + text, chosen.choice(["en", "de", None]), f"s{chosen.choice([0, 0, 0, 0, 1, 2])}", 0))
    return rows


def test_equals_brute_force(spark):
    rows = rows_of(4, 260)
    docs = with_clashes(spark.createDataFrame(rows, DOCS).repartition(3), "n_words", "_h", "kept", "measure")
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    for row, kept in zip(rows, brute(rows), strict=True):
        r = got[row[0]]
        counts, failed, _ = base(row[1])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == failed and r.kept == kept


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [tuple(r) for r in docs.collect()]
    want = sorted([(r[0], *base(r[1])[0], base(r[1])[1]) for r in rows], key=str)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rules.judge(docs).collect()]
    assert sorted(got, key=str) == want
    assert rules.judge(docs.limit(0)).count() == 0
