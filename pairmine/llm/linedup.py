"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its words, which white space separates.  A line is removed if an
earlier line (by doc_id, then line number) has a Jaccard similarity of at least
``NUMERATOR`` / ``DENOMINATOR`` with it, whether or not that earlier line stays.  Lines
of fewer than ``min_words`` words are left alone; with ``ALL_LINES``, which the query and
the stage use, these are the blank ones.  Words are compared by their 64-bit hashes, of
which 58 bits count.

Equal sets are one row from the start, however often they occur.  The words of a set
are ordered by rarity, taken from word counts in a fixed number of hash buckets (any
fixed order is exact, a rare first word only makes it fast).  Two similar sets share a
word of their prefixes, so the prefixes are joined on the word; length, position and a
parity bitmap of the set drop nearly all other pairs inside that join, and a pair meets
at the first of a row of common words only.  It is a semi join: it yields the sets that
have a partner at all, never pairs.  For those sets a second semi join compares all
words with the sets that come earlier.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine.llm.rows import release, sized
from pairmine.session import stage

NUMERATOR, DENOMINATOR = 4, 5
MIN_WORDS = 5
#: Every line with a word takes part.
ALL_LINES = 1
_BUCKETS = 1 << 16
#: White space inside a line that is not a blank.
_OTHER_GAPS = "[\\t\\x0b\\x0c\\r]"


def _long_enough(line: Column, min_words: int) -> Column:
    if min_words <= 1:
        return F.ltrim(line, F.lit(" \t\x0b\x0c\r")) != ""
    gap = r" \t\x0b\x0c\r"
    return line.rlike(f"^[{gap}]*+(?:[^{gap}]++[{gap}]++){{{min_words - 1}}}[^{gap}]")


def _words(line: Column) -> Column:
    """Words of a line, and an empty one for each further blank.

    A split at one plain character is far cheaper than at a pattern, and gaps other than
    blanks are rare.
    """
    blanks = F.when(line.rlike(_OTHER_GAPS), F.regexp_replace(line, _OTHER_GAPS, " ")).otherwise(line)
    return F.split(blanks, " ")


#: Classes of rarity; the first ones hold equal numbers of buckets.
_CLASSES = 64
_EVEN = 48


def _rank_classes(counts: list[int]) -> list[int]:
    """Class of each bucket, below 0 for half of the classes.

    Buckets with much the same counts, as all have in a corpus of many words, are told
    apart by rank.  Those of the last even class are, by powers of two of their count.
    """
    ranked = sorted(counts)
    top = max(1, ranked[(_EVEN - 1) * len(ranked) // _EVEN])
    classes = []
    for n in counts:
        even = bisect_left(ranked, n) * _EVEN // len(ranked)
        high = min(_CLASSES - 1, even + (n // top).bit_length())
        classes.append((high if n >= top else even) - _CLASSES // 2)
    return classes


def _rarity(docs: DataFrame) -> str:
    """Class of each bucket of word hashes, by the words counted in it."""
    counted = (
        docs.select(F.explode(F.split("text", "[ \\n\\t\\x0b\\x0c\\r]")).alias("w"))
        .filter("w <> ''")
        .groupBy(F.expr(f"cast(xxhash64(w) & {_BUCKETS - 1}L as int)").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = [0] * _BUCKETS
    for row in counted.collect():  # one row per bucket
        counts[row["bucket"]] = row["n"]
    return ",".join(map(str, _rank_classes(counts)))


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, rid, line_no, line) of the lines with enough words."""
    split = docs.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("rid"),
        F.posexplode(F.split("text", "\n")).alias("line_no", "line"),
    )
    return split.filter(_long_enough(F.col("line"), min_words))


def _lines_at(docs: DataFrame, holders: DataFrame) -> DataFrame:
    """(doc_id, rid, line_no, line, more) of the lines that ``items`` of (line_no, more) name."""
    keyed = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    same = (keyed["rid"] == holders["rid"]) & keyed["doc_id"].eqNullSafe(holders["doc_id"])
    # A text is split once, below the generator.
    split = keyed.join(holders, same).select(keyed["doc_id"], keyed["rid"], F.split("text", "\n").alias("lines"), "items")
    named = split.select("doc_id", "rid", "lines", F.inline("items"))
    return named.withColumn("line", F.expr("get(lines, line_no)")).drop("lines")


def _sets(lines: DataFrame, classes: str, *more: str) -> DataFrame:
    """(doc_id, rid, line_no, r, more): ``r`` has the distinct words as numbers, rarest first."""
    hashes = F.array_distinct(F.transform(_words(F.col("line")), lambda w: F.xxhash64(w)))
    words = lines.withColumn("h", F.array_remove(hashes, F.xxhash64(F.lit(""))))
    number = (
        f"transform(h, x -> shiftleft(cast(coalesce(get(cast(split('{classes}', ',') as array<tinyint>), "
        f"cast(x & {_BUCKETS - 1}L as int)), 0Y) as bigint), 58) | shiftrightunsigned(x, 6))"
    )
    # Without nulls and in front of the generator, the numbers are sorted by generated code.
    ordered = words.select("doc_id", "rid", "line_no", F.sort_array(F.expr(number)).alias("ordered"), *more)
    # A generator keeps the numbers from being computed once per use.
    return ordered.select("doc_id", "rid", "line_no", F.explode(F.array("ordered")).alias("r"), *more)


#: The prefixes are joined on 32 bits of a word; equal bits of other words lose nothing.
_SHORT = "cast((x & 4294967295L) - 2147483648L as int)"


def _prefix(n: str) -> str:
    """Length of the prefix of a set of ``n`` words."""
    return f"{n} - ({NUMERATOR} * {n} + {DENOMINATOR - 1}) div {DENOMINATOR} + 1"


#: Sets of up to this many words have 64 parity bits, longer ones 128.
_SHORT_SET = 100


def _parity() -> list[Column]:
    """``s0`` and ``s1``: parity bits of the words.

    ``s0`` has 64 bits for all words; ``s1``, of long sets only, those of the words in
    the upper half of the hash range, so both give 64 bits for each half.
    """
    bit = "shiftleft(1L, cast(x & 63L as int))"
    high = f"aggregate(r, 0L, (s, x) -> s ^ if((x & 64L) = 64L, {bit}, 0L))"
    return [
        F.expr(f"aggregate(r, 0L, (s, x) -> s ^ {bit})").alias("s0"),
        F.expr(f"if(size(r) <= {_SHORT_SET}, 0L, {high})").alias("s1"),
    ]


def _overlap(l_n: str, e_n: str) -> str:
    """Least common words of two similar sets."""
    return f"(({NUMERATOR} * ({l_n} + {e_n}) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR})"


def _differences(l_n: str, e_n: str) -> str:
    """Most words that only one of two similar sets has, times ``NUMERATOR + DENOMINATOR``."""
    return f"{DENOMINATOR - NUMERATOR} * ({l_n} + {e_n})"


def _lengths(l_n: str, e_n: str) -> str:
    """Length filter."""
    return f"{DENOMINATOR} * {l_n} >= {NUMERATOR} * {e_n} and {DENOMINATOR} * {e_n} >= {NUMERATOR} * {l_n}"


def _bitmaps(l_n: str, e_n: str) -> str:
    """Bitmap filter."""
    return f"""if(({l_n} <= {_SHORT_SET}) = ({e_n} <= {_SHORT_SET}),
        bit_count(l.s0 ^ l.s1 ^ e.s0 ^ e.s1) + bit_count(l.s1 ^ e.s1),
        bit_count(l.s0 ^ e.s0)) * {NUMERATOR + DENOMINATOR} <= {_differences(l_n, e_n)}"""


def _semi(rows: DataFrame, condition: str) -> DataFrame:
    """Rows for which another row of the same word meets the condition."""
    return rows.alias("l").hint("merge").join(rows.alias("e"), F.expr(condition), "left_semi")


def _tokens(sets: DataFrame) -> DataFrame:
    """A row for each word of the prefixes, as few bytes as the join needs.

    ``words`` is the word and the one before it, ``sizes`` the size of the set and the
    place of the word there, two numbers of 32 bits each.  A set of so few words that
    only equal ones are similar has no row.
    """
    able = sets.filter(f"{DENOMINATOR - NUMERATOR} * n >= {NUMERATOR}")
    placed = able.select(F.xxhash64("at").alias("place"), "s0", "s1", "n", "p")
    number = {
        "s0": "s0",
        "words": "shiftleft(cast(token as bigint), 32) | (coalesce(get(p, pos - 1), 0) & 4294967295L)",
        "sizes": "shiftleft(cast(n as bigint), 32) | pos",
        "s1": "s1",
    }
    # None is null; where Spark knows, it compares without looking.
    sure = [F.expr(f"coalesce({value}, 0L)").alias(name) for name, value in number.items()]
    return placed.select("*", F.posexplode("p").alias("pos", "token")).select("place", *sure)


def _shared(tokens: DataFrame) -> DataFrame:
    """(place, token): words that a set shares with a possible partner.

    A pair meets at its first common word, where all words before are differences.  If
    the word before is the same, too, that is at an earlier one, under the same filters.
    """
    token = "shiftrightunsigned({}.words, 32)"
    l_n, e_n = "shiftright(l.sizes, 32)", "shiftright(e.sizes, 32)"
    l_pos, e_pos = "(l.sizes & 4294967295L)", "(e.sizes & 4294967295L)"
    possible = f"""{token.format("l")} = {token.format("e")}
        and {NUMERATOR + DENOMINATOR} * ({l_pos} + {e_pos}) <= {_differences(l_n, e_n)}
        and {_lengths(l_n, e_n)}
        and {NUMERATOR + DENOMINATOR} * least({l_n} - {l_pos}, {e_n} - {e_pos}) >= {NUMERATOR} * ({l_n} + {e_n})
        and (l.words <> e.words or {l_pos} = 0 or {e_pos} = 0)
        and (l.place <> e.place or l.s0 <> e.s0 or l.s1 <> e.s1)
        and {_bitmaps(l_n, e_n)}"""
    return _semi(tokens, possible).select("place", F.expr("cast(shiftright(words, 32) as int)").alias("token"))


def kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, rid, kept): per document, the numbers of its lines of enough words that stay.

    ``rid`` is the hash of doc_id and text and tells rows of equal doc_id apart; rows that
    repeat an id and its text are one document.  Null ids come first.  A document
    without such lines has no row.
    """
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    classes = _rarity(docs)
    at = F.struct("doc_id", "rid", "line_no")
    described = _sets(_lines(docs, min_words), classes).select(
        F.xxhash64("r").alias("k1"),
        *_parity(),
        at.alias("at"),
        F.size("r").alias("n"),
        F.expr(f"transform(slice(r, 1, {_prefix('size(r)')}), x -> {_SHORT})").alias("p"),
    )
    firsts = [F.first(c).alias(c) for c in ("n", "p")]
    sets = stage(described.groupBy("k1", "s0", "s1").agg(F.min("at").alias("at"), *firsts), "line-sets")
    release(spark)
    # Both sides of the join are one plan, and its shuffle is made once.
    shared = stage(_shared(_tokens(sets)), "line-shared")
    release(spark)
    # A set goes by the hash of its first line's place.  Should another set's have the
    # same, it is compared as well.
    tokens = sized(shared.groupBy("place").agg(F.collect_set("token").alias("tokens")), "line-places", "tokens")
    maybe = sets.select(F.xxhash64("at").alias("place"), "at.*").join(tokens, "place")
    items = F.collect_list(F.struct("line_no", "tokens")).alias("items")
    holders = sized(maybe.groupBy("doc_id", "rid").agg(items), "line-holders", "items")
    full = _sets(_lines_at(docs, holders), classes, "tokens").select(at.alias("at"), "r", F.size("r").alias("n"), *_parity(), "tokens")
    keyed = stage(full, "line-words").select("at", "r", "n", "s0", "s1", F.explode("tokens").alias("token"))
    # Both sides need the same columns, so this shuffle is made once, too.
    earlier = f"l.token = e.token and e.at < l.at and {_lengths('l.n', 'e.n')} and {_bitmaps('l.n', 'e.n')}"
    same = f"size(array_intersect(l.r, e.r)) >= {_overlap('l.n', 'e.n')}"
    later = stage(_semi(keyed, f"{earlier} and {same}").select("at"), "line-later")
    release(spark)
    # What goes is listed as the numbers below 0.
    places = ("at.doc_id", "at.rid")
    listed = sets.select(*places, "at.line_no").union(later.select(*places, F.expr("-1 - at.line_no")))
    by_doc = listed.groupBy("doc_id", "rid").agg(F.collect_list("line_no").alias("all"))
    kept = by_doc.withColumn("kept", F.expr("filter(array_except(all, transform(all, x -> -1 - x)), x -> x >= 0)"))
    return kept.filter(F.size("kept") > 0).drop("all")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` (doc_id, text) with the repeated lines taken out of ``text``.

    Adds ``n_lines`` and ``n_removed``.  The text of a document that loses no line is
    unchanged, null stays null, empty texts have one empty line, all other columns are
    kept and no rows give no rows.
    """
    kept = kept_lines(docs, min_words)
    facts = sized(
        kept.select(F.col("doc_id").alias("_of"), F.col("rid").alias("_rid"), F.col("kept").alias("_kept")),
        "line-kept",
    )
    plain = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    keyed = docs.select(*[docs[c] for c in plain]).withColumn("_rid", F.xxhash64(F.col("doc_id").cast("long"), "text"))
    same = (keyed["_rid"] == facts["_rid"]) & keyed["doc_id"].cast("long").eqNullSafe(facts["_of"])
    joined = keyed.join(facts, same, "left")
    listed = joined.withColumn("_lines", F.split("text", "\n"))
    staying = F.filter(
        F.col("_lines"),
        lambda line, i: ~_long_enough(line, min_words) | F.coalesce(F.array_contains(F.col("_kept"), i), F.lit(False)),
    )
    stays = listed.withColumn("_stay", F.explode(F.array(staying)))
    removed = F.size("_lines") - F.size("_stay")
    text = F.when(removed > 0, F.array_join("_stay", "\n")).otherwise(F.col("text"))
    return stays.select(
        *[text.alias("text") if c == "text" else keyed[c] for c in plain],
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines taken out and ``n_chars`` set to the new length.

    A document of which nothing but blank lines is left goes.
    """
    cleaned = dedup_lines(docs, ALL_LINES)
    kept = cleaned.filter((F.col("n_removed") == 0) | F.col("text").rlike("[^ \\t\\x0b\\x0c\\r\\n]"))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select(*[length.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])
