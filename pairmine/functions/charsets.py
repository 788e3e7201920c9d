"""Which character set wrote a page that declares none, in expressions.

Bytes are looked at through ISO-8859-1, a character each.  Every candidate set is scored by
the share of the page's high bytes that it explains: letters of an alphabet of its own by
pairs of frequent letters next to each other, accented Latin letters by standing next to
a plain one, two-byte sets by frequent characters, provided that the whole page is well formed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent letters of languages with an alphabet of their own, and the sets
# (Python's name, Java's name) that write them.
ALPHABETS = {
    "оеаинтсрвлкмдпуяыьгзбчі": [
        ("cp1251", "windows-1251"), ("koi8_u", "KOI8-U"), ("iso8859_5", "ISO-8859-5"), ("cp866", "IBM866"),
    ],
    "αοιετσνηυρπκμλςωγδάέήίόύώ": [("cp1253", "windows-1253")],
    "יוהלארתבשמנםדקעחפ": [("cp1255", "windows-1255")],
    "ايلمونرتبةعدسفهكقأحج": [("cp1256", "windows-1256")],
    "านรอกเงมยลวดทสตะปบคหแ่้ิีัุ็์": [("cp874", "x-windows-874")],
}
# Accented letters of languages in Latin script, and the sets that write them.
ACCENTS = {
    "àáâãäåæçèéêëìíîïñòóôõöøùúûüß": [("cp1252", "windows-1252")],
    "çğıöşü": [("cp1254", "windows-1254")],
    "áąčćďéěęíłňńóöőřśšťúůüűýźžż": [("cp1250", "windows-1250"), ("iso8859_2", "ISO-8859-2")],
}
# Frequent characters of two-byte sets, how a page of the set is built, and its name.
_EUC = r"[\xa1-\xfe][\xa1-\xfe]"
TWO_BYTES = [
    ("のにはをたがでてとしれさるなりかまいもっらこす、。ーンスルト",
     r"[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]|[\xa1-\xdf]", "cp932", "windows-31j"),
    ("のにはをたがでてとしれさるなりかまいもっらこす、。ーンスルト",
     rf"{_EUC}|\x8e[\xa1-\xdf]|\x8f{_EUC}", "euc_jp", "EUC-JP"),
    ("的一是不了人在有我他这中大来上国个到说们为子和你地出道也时年，。",
     r"[\x81-\xfe](?:[\x40-\x7e\x80-\xfe]|[0-9][\x81-\xfe][0-9])", "gb18030", "GB18030"),
    ("的一是不了人在有我他這中大來上國個到說們為子和你地出道也時年，。",
     r"[\x81-\xfe][\x40-\x7e\xa1-\xfe]", "big5", "Big5"),
    ("이다에의는가을를하고지한은로서도사기어나리자시그인아대있",
     r"[\x81-\xfe][\x41-\x5a\x61-\x7a\x81-\xfe]", "euc_kr", "x-windows-949"),
]
#: A set has to explain this share of the high bytes, and UTF-8 with damage this one.
LEAST = 0.15
LEAST_UTF8 = 0.7
#: Frequent characters of a two-byte set are about half of a text at most.
_TWO_BYTE_WEIGHT = 2.0
_UTF8 = r"[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}"


def _one_of(letters: str, codec: str) -> str:
    """Class of the bytes that write the letters; letters the set lacks are left out."""
    return "[" + "".join(f"\\x{b:02x}" for b in letters.encode(codec, errors="ignore") if b >= 0x80) + "]"


def _scores(page: Column, high: Column) -> list[tuple[Column, str]]:
    def share(pattern: str, weight: float = 1.0) -> Column:
        return F.regexp_count(page, F.lit(pattern)) * weight / high

    out = []
    for letters, sets in ACCENTS.items():
        for codec, name in sets:
            some = _one_of(letters, codec)
            out.append((share(f"(?<=[A-Za-z]){some}|{some}(?=[a-z])"), name))
    for letters, sets in ALPHABETS.items():
        for codec, name in sets:
            some = _one_of(letters, codec)
            out.append((share(f"{some}(?={some})"), name))
    for characters, unit, codec, name in TWO_BYTES:
        frequent = "|".join("".join(f"\\x{b:02x}" for b in c.encode(codec)) for c in characters)
        formed = page.rlike(f"^(?:[\\x00-\\x7f]|{unit})*+$")
        # A match goes on where the last one ended, so none begins inside a character.
        counted = share(f"\\G(?:[\\x00-\\x7f]++|(?!{frequent})(?:{unit}))*+(?:{frequent})", 2 * _TWO_BYTE_WEIGHT)
        out.append((F.when(formed, counted).otherwise(0.0), name))
    return out


def guessed_charset(html_bytes: Column) -> Column:
    """Java's name of the set that explains most of the page's high bytes.

    Null if none explains ``LEAST`` of them, if most of them are well-formed UTF-8, and for
    null, empty and ASCII pages.  Of equal shares the first in the order of the tables counts.
    """
    page = F.decode(html_bytes, "ISO-8859-1")
    high = F.nullif(F.regexp_count(page, F.lit(r"[\x80-\xff]")), F.lit(0))
    left = F.regexp_count(F.regexp_replace(page, _UTF8, ""), F.lit(r"[\x80-\xff]"))
    ranked = [
        F.struct(score.cast("double").alias("score"), F.lit(-number).alias("place"), F.lit(name).alias("name"))
        for number, (score, name) in enumerate(_scores(page, high))
    ]
    best = F.array_max(F.array(*ranked))
    return F.when(left <= (1 - LEAST_UTF8) * high, F.lit(None).cast("string")).otherwise(
        F.get(F.transform(F.array(best), lambda b: F.when(b["score"] >= LEAST, b["name"])), 0)
    )
