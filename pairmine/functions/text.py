"""Text expressions: whitespace, entities, loose matching, word counts, tokens."""

from __future__ import annotations

import html.entities
import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space.
WHITESPACE = "[\\s\\p{Z}\\x1c\\x1d\\x1e\\x1f\\x85]+"
# The 32 ASCII punctuation marks.
PUNCTUATION = "\\p{Punct}+"
WORD = "[\\p{L}\\p{N}_]+"
TOKEN = "[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_\\s\\p{Z}\\x1c\\x1d\\x1e\\x1f\\x85]"


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space become one blank; none is left at either end."""
    return F.btrim(F.regexp_replace(text, WHITESPACE, " "))


def normalize_text(text: Column) -> Column:
    """Loose-match form: lower case, no ASCII punctuation, single blanks; null gives ''."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return collapse_whitespace(F.regexp_replace(lowered, PUNCTUATION, ""))


def word_count(text: Column) -> Column:
    """Number of word runs."""
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))


def has_words(text: Column, count: int) -> Column:
    """At least ``count`` word runs; reads no further than it must."""
    other, word = "[^\\p{L}\\p{N}_]*+", "[\\p{L}\\p{N}_]++"
    return text.rlike(f"^{other}(?:{word}{other}){{{count}}}+")


def tokenize(text: Column) -> Column:
    """Lower-cased word runs and single other characters, in order."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def hash_ids(tokens: Column, first_id: int, buckets: int) -> Column:
    """Token ids without a vocabulary: ``first_id`` plus the token's hash bucket."""
    return F.transform(
        tokens, lambda t: (F.pmod(F.xxhash64(t), F.lit(buckets)) + first_id).cast("int")
    )


_NAME_BUCKETS = 256


def _named_character(name: Column) -> Column:
    """The characters of a reference's name, null for an unknown one.

    The names are those of the standard library's table, in buckets, because a map is
    searched entry by entry.
    """
    buckets: list[dict[str, str]] = [{} for _ in range(_NAME_BUCKETS)]
    for known, chars in html.entities.html5.items():
        buckets[zlib.crc32(known.encode()) % _NAME_BUCKETS][known] = chars
    table = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,string>>")
    return F.try_element_at(F.get(table, (F.crc32(name.cast("binary")) % _NAME_BUCKETS).cast("int")), name)


def _numbered_character(point: Column) -> Column:
    """The character of a code point; 128 to 159 mean their windows-1252 characters."""
    western = [bytes([p]).decode("cp1252", errors="ignore") or chr(p) for p in range(128, 160)]
    wide = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    return (
        F.when(point.between(128, 159), F.get(F.array(*map(F.lit, western)), (point - 128).cast("int")))
        .when((point < 9) | point.between(64976, 65007), "")
        .when((point > 1114111) | point.between(55296, 57343), "\ufffd")
        .otherwise(wide)
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def decode_entities(column: str, in_attribute: bool = False) -> Column:
    """Resolve the character references in the text column of that name, in one pass.

    The text is cut at each ampersand and every piece is resolved by itself, so nothing
    is decoded twice and the time is linear.  Numbers may have leading zeros, and the
    semicolon may be missing behind a number or one of the names that need none; inside
    an attribute such a name counts only if neither a letter, a digit nor ``=`` follows.
    """
    bare = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    bare_name = f"^(?:{'|'.join(bare)})" + ("(?![=a-zA-Z0-9])" if in_attribute else "")

    def numbered(piece: Column, start: str, digit: str, base: int, most: int) -> Column:
        digits = F.regexp_extract(piece, f"{start}0*+({digit}*+)", 1)
        value = F.conv(F.concat(F.lit("0"), digits), base, 10).cast("long")
        point = F.when(F.length(digits) > most, F.lit(1114112).cast("long")).otherwise(value)
        return F.concat(_let(point, _numbered_character), F.regexp_replace(piece, f"{start}{digit}++;?+", ""))

    def named(piece: Column) -> Column:
        def resolved(name: Column, otherwise: Column) -> Column:
            rest = F.substring(piece, F.length(name) + 1, F.length(piece))
            return F.coalesce(_let(name, lambda n: F.concat(_named_character(n), rest)), otherwise)

        whole = F.regexp_extract(piece, "^[a-zA-Z][a-zA-Z0-9]*+;", 0)
        short = F.regexp_extract(piece, bare_name, 0)
        return resolved(whole, resolved(short, F.concat(F.lit("&"), piece)))

    def decoded(piece: Column, index: Column) -> Column:
        return (
            F.when(index == 0, piece)
            .when(piece.rlike("^#[0-9]"), numbered(piece, "^#", "[0-9]", 10, 7))
            .when(piece.rlike("^#[xX][0-9a-fA-F]"), numbered(piece, "^#[xX]", "[0-9a-fA-F]", 16, 6))
            .when(piece.rlike("^[a-zA-Z]"), named(piece))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    text = F.col(column)
    return F.when(
        F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&", -1), decoded), "")
    ).otherwise(text)
