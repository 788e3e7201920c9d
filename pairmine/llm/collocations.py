"""Phrases whose words occur together more often than their parts, per language.

Tasks count the phrases of one to three words of their share of the texts and build a
weighted acyclic automaton (``transducers``) from the sorted phrases of every prefix
range.  The automata of a range meet in one task, which unites them and sums the weights;
only phrases found often enough are kept, as whatever part of a candidate is looked up
occurs at least as often.  The kept phrases of some ranges make a shelf.  The parts that its
candidates need are sent as automata to the shelves that hold them, composed with the counts
there, and sent back.  A request also carries the largest count of the phrases that ask, so
a shelf learns which of its candidates lie inside longer ones.

A prefix range is an interval of the first two words.  Its bounds come from a bounded sample
(``SAMPLE_DOCS``) and decide only which task sums what.  Beyond ``MAX_RANGES`` a range is
divided by a hash of the first two words.  A phrase costs a task one entry however often it
occurs, and a word one request per shelf however many candidates hold it, so hot words and
pairs need no salt.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code
from pairmine.llm.rows import sized
from pairmine.llm.transducers import DEPTH, Phrases, Transducer, keys, merge_words, summed, union
from pairmine.session import stage

MIN_COUNT = 10
INSIDE = (50, 100)
TOP = 2_000
SCALE = 1_000_000
UNKNOWN = "und"
SHARD_WORDS = 3_000_000
RANGE_WORDS = 500_000
MAX_RANGES = 4_096
#: Ranges whose frequent phrases are looked up together.
SHELF_RANGES = 16
SAMPLE_DOCS = 4_000
_SAMPLE_EACH = 64
_SAMPLE_MOST = 256
_BOUND_BYTES = 64
_BLOCK_BYTES = 4 << 20
#: Cannot occur in UTF-8; stands between pieces, and sorts behind every word.
_BREAK = b"\xff"
_PIECES = bytes(
    0xFF if b in b".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256)
)
_SLICE = "lang string, part long, kind string, sender long, data binary"

#: Per language the bounds (first word, second word) of its ranges, and the hash classes of each.
Ranges = dict[str, tuple[list[tuple[bytes, bytes]], int]]


def tokens(texts: list[str]) -> Iterator[list[bytes]]:
    """Lower-cased words of the texts, a break after each piece, in lists of bounded size."""
    raw = b"".join(t.encode("utf-8", "surrogatepass") + b"\n" for t in texts).translate(_PIECES)
    low = 0
    while low < len(raw):
        high = raw.find(_BREAK, min(low + _BLOCK_BYTES, len(raw) - 1)) + 1 or len(raw)
        yield raw[low:high].replace(_BREAK, b" \xff ").split(b" ")
        low = high


class _Shard:
    """The words of one language in one task, until they are counted."""

    def __init__(self):
        self.numbers: list[np.ndarray] = []
        self.words: list[pa.Array] = []
        self.held = 0

    def add(self, texts: list[str]) -> None:
        for block in tokens(texts):
            coded = pa.array([w for w in block if w], pa.binary()).dictionary_encode()
            self.numbers.append(coded.indices.to_numpy())
            self.words.append(coded.dictionary)
            self.held += len(coded)

    def counted(self) -> Phrases:
        words, new = merge_words(self.words)
        line = np.concatenate([n[i] for n, i in zip(new, self.numbers, strict=True)])
        last = len(words) - 1  # the break
        inside = line != last
        columns = []
        for k in range(1, DEPTH + 1):
            whole = np.logical_and.reduce([inside[j : len(line) - k + 1 + j] for j in range(k)])
            spelled = [line[j : len(line) - k + 1 + j][whole] for j in range(k)]
            columns.append(summed(spelled, np.ones(len(spelled[0]), dtype=np.int64), len(words)))
        return Phrases(words, columns)


def _parts(phrases: Phrases, ranges: tuple[list[tuple[bytes, bytes]], int]) -> list[np.ndarray]:
    """Per length the part (range and hash class) of each phrase."""
    bounds, classes = ranges
    known = phrases.words.to_pylist()
    width = len(known) + 1
    edges = []
    for one, two in bounds:
        i = bisect.bisect_left(known, one)
        equal = i < len(known) and known[i] == one
        edges.append(i * width + (bisect.bisect_left(known, two) + 1 if equal and two else 0))
    edges = np.array(sorted(edges), dtype=np.int64)
    hashed = np.array([zlib.crc32(w) for w in known], dtype=np.int64) if classes > 1 else None
    out = []
    for columns in phrases.columns:
        second = columns[1] + 1 if len(columns) > 2 else np.zeros(len(columns[-1]), dtype=np.int64)
        part = np.searchsorted(edges, columns[0] * width + second, side="right")
        if hashed is not None:
            part = part * classes + (hashed[columns[0]] * 31 + np.append(hashed, 0)[second - 1]) % classes
        out.append(part)
    return out


def _slices(
    phrases: Phrases, ranges: tuple[list[tuple[bytes, bytes]], int], together: int = 1
) -> Iterator[tuple[int, bytes]]:
    """An automaton for each part, or for so many parts ``together``, that has phrases."""
    parts = [p // together for p in _parts(phrases, ranges)]
    orders = [np.argsort(p, kind="stable") for p in parts]
    rows = [p[o] for p, o in zip(parts, orders, strict=True)]
    for part in np.unique(np.concatenate(rows)).tolist():
        chosen = [
            o[np.searchsorted(r, part) : np.searchsorted(r, part, "right")] for r, o in zip(rows, orders, strict=True)
        ]
        yield part, Transducer.build(phrases.select(chosen)).to_bytes()


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("lang", pa.string()), ("part", pa.int64()), ("kind", pa.string()), ("sender", pa.int64()), ("data", pa.binary())]
    columns = [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in kinds])


def _ranges_of(docs: DataFrame) -> Ranges:
    """Prefix ranges of about ``RANGE_WORDS`` words, from the prefixes of sampled documents."""
    count = docs.count()
    share = min(1.0, SAMPLE_DOCS / max(1, count))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = [w for block in tokens([text]) for w in block if w]
                step = max(_SAMPLE_EACH, len(words) // _SAMPLE_MOST)
                for i in range(0, len(words), step):
                    pair = [w[:_BOUND_BYTES] for w in (words[i : i + 2] + [b""])[:2]]
                    pair = [b"" if w == _BREAK else w for w in pair]
                    rows.append((lang, min(step, len(words) - i), None, 0, b"\xff".join(pair)))
            yield _records(rows)

    sampled = docs.sample(share, 1).mapInArrow(prefixes, _SLICE).select("lang", "part", "data")
    found: dict[str, tuple[int, set]] = {}
    for lang, words, pair in sampled.toLocalIterator():  # at most _SAMPLE_MOST + 1 a sampled document
        held, known = found.setdefault(lang, (0, set()))
        known.add(tuple(bytes(pair).split(b"\xff")))
        found[lang] = (held + words, known)
    total = sum(words for words, _ in found.values()) / share
    cores = docs.sparkSession.sparkContext.defaultParallelism
    wanted = max(2 * cores, total / RANGE_WORDS)
    ranges: Ranges = {}
    for lang, (words, known) in found.items():
        own = max(1, round(wanted * words / share / max(1, total)))
        classes = -(-own // MAX_RANGES)
        pairs, own = sorted(known), -(-own // classes)
        ranges[lang] = (sorted({pairs[len(pairs) * k // own] for k in range(1, own)}), classes)
    return ranges


def _count(docs: DataFrame, ranges: Ranges) -> DataFrame:
    """Automata of the phrases of each task, a row per prefix range and batch of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[str, _Shard] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(shards):
                phrases = shards.pop(lang).counted()
                for part, data in _slices(phrases, ranges.get(lang, ([], 1))):
                    yield _records([(lang, part, "counts", part, data)])

        def hold(texts: dict[str, list[str]]) -> Iterator[pa.RecordBatch]:
            for lang, some in texts.items():
                shards.setdefault(lang, _Shard()).add(some)
            texts.clear()
            if sum(s.held for s in shards.values()) >= SHARD_WORDS:
                yield from flush()

        for batch in batches:
            texts: dict[str, list[str]] = {}
            held = 0
            for lang, text in zip(*batch.columns, strict=True):
                texts.setdefault(lang.as_py(), []).append(text.as_py())
                held += len(texts[lang.as_py()][-1])
                if held >= _BLOCK_BYTES:
                    yield from hold(texts)
                    held = 0
            yield from hold(texts)
        yield from flush()

    return docs.mapInArrow(run, _SLICE)


def _rows_of(table: pa.Table, kind: str) -> list[Transducer]:
    own = table.filter(pa.compute.equal(table["kind"], kind))
    return [Transducer.from_bytes(d.as_py()) for d in own["data"]]


def _asked(phrases: Phrases, least: int) -> Phrases:
    """The parts that the candidates among the phrases need; two-word parts carry the largest count that asks."""
    _, two, three = phrases.columns
    x, y, a = (c[two[-1] >= least] for c in two)
    p, q, r, b = (c[three[-1] >= least] for c in three)
    words = max(1, len(phrases.words))
    one = np.concatenate([x, y, p, r])
    single = summed([one], np.ones(len(one), dtype=np.int64), words)
    pair = summed([np.concatenate([p, q]), np.concatenate([q, r])], np.concatenate([b, b]), words, np.maximum)
    none = [np.zeros(0, dtype=np.int64)] * (DEPTH + 1)
    return Phrases(phrases.words, [single, pair, none])


def _unite(least: int):
    """Makes the automaton of the frequent phrases of a range, and its number of words."""

    def run(table: pa.Table) -> pa.Table:
        lang, part = table["lang"][0].as_py(), table["part"][0].as_py()
        phrases = union(_rows_of(table, "counts"))
        rows = [(lang, part, "total", int(phrases.columns[0][-1].sum()), None)]
        often = phrases.select([c[-1] >= least for c in phrases.columns])
        if len(often.words):
            rows.append((lang, part, "often", part, Transducer.build(often).to_bytes()))
        return pa.Table.from_batches([_records(rows)])

    return run


def _ask(ranges: Ranges, least: int):
    """Makes the automaton of a shelf, the frequent phrases of some ranges, and its requests."""

    def run(table: pa.Table) -> pa.Table:
        lang, shelf = table["lang"][0].as_py(), table["part"][0].as_py()
        often = union(_rows_of(table, "often"))
        asked = _slices(_asked(often, least), ranges.get(lang, ([], 1)), SHELF_RANGES)
        rows = [(lang, shelf, "kept", shelf, Transducer.build(often).to_bytes())]
        rows += [(lang, to, "asked", shelf, data) for to, data in asked]
        return pa.Table.from_batches([_records(rows)])

    return run


def _answer(table: pa.Table) -> pa.Table:
    """The counts of what other shelves ask for, and the largest count that asks for each own pair."""
    lang, part = table["lang"][0].as_py(), table["part"][0].as_py()
    counts = _rows_of(table, "kept")
    asked = table.filter(pa.compute.equal(table["kind"], "asked"))
    rows, requests = [], []
    for sender, data in zip(asked["sender"].to_pylist(), asked["data"], strict=True):
        request = Transducer.from_bytes(data.as_py())
        requests.append(request)
        wanted = request.phrases()
        found = counts[0].compose(wanted)
        answer = Phrases(wanted.words, [[*c[:-1], f] for c, f in zip(wanted.columns, found, strict=True)])
        rows.append((lang, sender, "answer", part, Transducer.build(answer).to_bytes()))
    if requests:
        longest = union(requests, np.maximum)
        rows.append((lang, part, "longer", part, Transducer.build(longest).to_bytes()))
    return pa.Table.from_batches([_records(rows)])


def _score(least: int, inside: tuple[int, int]):
    """Makes the rows (lang, phrase, a, l, r, score) of the candidates of a shelf."""

    def run(table: pa.Table) -> pa.Table:
        kept = _rows_of(table, "kept")
        lang, out = table["lang"][0].as_py(), []
        if kept:
            phrases = kept[0].phrases()
            phrases = phrases.select([c[-1] >= least for c in phrases.columns])
            known = Transducer.build(union(_rows_of(table, "answer")))
            longer = Transducer.build(union(_rows_of(table, "longer")))
            out = [*_scored(phrases, 2, known, longer, inside), *_scored(phrases, 3, known, longer, inside)]
        names = ("phrase", "a", "l", "r", "score")
        columns = [pa.array([row[k] for row in out], pa.int64() if k else pa.string()) for k in range(5)]
        return pa.Table.from_arrays([pa.array([lang] * len(out), pa.string()), *columns], ["lang", *names])

    return run


def _scored(
    phrases: Phrases, size: int, known: Transducer, longer: Transducer, inside: tuple[int, int]
) -> list[tuple]:
    """(phrase, a, l, r, score) of the phrases of ``size`` words that no longer one replaces."""
    words, a = phrases.columns[size - 1][:-1], phrases.columns[size - 1][-1]

    def counts_of(table: Transducer, spelled: list[np.ndarray]) -> np.ndarray:
        asked = [[np.zeros(0, dtype=np.int64)] * (k + 1) for k in range(1, DEPTH + 1)]
        asked[len(spelled) - 1] = [*spelled, a]
        return table.compose(Phrases(phrases.words, asked))[len(spelled) - 1]

    if size == 2:
        part, whole = inside
        free = (counts_of(longer, words).astype(object) * whole < part * a.astype(object)).astype(bool)
        words, a = [c[free] for c in words], a[free]
    best = None
    for cut in range(1, size):
        left, right = counts_of(known, words[:cut]), counts_of(known, words[cut:])
        # Python's integers: the products pass 64 bits.
        score = (a.astype(object) ** 2 * SCALE) // (left.astype(object) * right.astype(object)) if len(a) else a
        found = [np.asarray(v, dtype=np.int64) for v in (score, left, right)]
        best = found if best is None else [np.where(found[0] < best[0], f, b) for f, b in zip(found, best, strict=True)]
    spelled = zip(*(phrases.words.take(pa.array(c)).to_pylist() for c in words), strict=True)
    texts = [b" ".join(own).decode("utf-8", "surrogatepass") for own in spelled]
    score, left, right = (v.tolist() for v in best)
    return list(zip(texts, a.tolist(), left, right, score, strict=True))


def collocations(
    docs: DataFrame, top: int = TOP, least: int = MIN_COUNT, inside: tuple[int, int] = INSIDE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language of ``docs`` (text, lang).

    Texts are cut into pieces at ``[.,;:!?]`` and line ends and into words at blanks and
    tabs, A-Z lower-cased.  ``a`` counts a phrase of two or three words within pieces, overlaps
    included, ``n`` all words of the language.  Of the cuts into two parts with counts ``l`` and
    ``r`` the one with the least ``score``, floor(1,000,000 a a / (l r)), counts; ties go to
    the shortest first part.  Phrases need ``least`` occurrences and are dropped if a three-word
    phrase around them has at least ``inside[0]`` of ``inside[1]`` of their count.  Rank is by score and a,
    falling, then by the bytes of the phrase.

    Null texts are empty, a null language is ``und``, repeated rows count again, and other columns
    play no part.  A language without such phrases has no row; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    given = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = _ranges_of(given)
    grouped = ("lang", "part")
    united = stage(_count(given, ranges).groupBy(*grouped).applyInArrow(_unite(least), _SLICE), "phrase-counts")
    often = united.filter("kind = 'often'").withColumn("part", F.floor(F.col("part") / SHELF_RANGES))
    shelves = stage(often.groupBy(*grouped).applyInArrow(_ask(ranges, least), _SLICE), "phrase-shelves")
    answers = stage(shelves.groupBy(*grouped).applyInArrow(_answer, _SLICE), "phrase-answers")
    told = shelves.filter("kind = 'kept'").unionByName(answers)
    scored = told.groupBy(*grouped).applyInArrow(
        _score(least, inside), "lang string, phrase string, a long, l long, r long, score long"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = united.filter("kind = 'total'").groupBy("lang").agg(F.sum("sender").alias("n"))
    return ranked.join(sized(totals, "phrase-totals"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
