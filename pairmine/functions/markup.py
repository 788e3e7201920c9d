"""HTML expressions: body, images, attributes, visible text.

Everything stays a native regular expression, so pages never leave the JVM.
The quantifiers over tag contents are possessive: the matcher then loops instead
of recursing, and an unclosed tag or quote cannot make it back-track.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pairmine.functions.charsets import guessed_charset

# Marks a kept image inside the text: START <position> STOP.
ANCHOR_START = "\u0001"
ANCHOR_STOP = "\u0002"

# Elements whose content is not markup.
RAW_ELEMENTS = ["script", "style", "template", "iframe", "noembed", "noframes", "textarea"]
# Elements whose text is not shown (no-script text and form fields).
HIDDEN_ELEMENTS = ["noscript", "select", "datalist", "button", "label"]
# Elements that do not separate words.
INLINE_ELEMENTS = [
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
]

_ATTRIBUTES = "[^>=]*+(?:=\\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+"
_TAIL = "(?:[\\s/]" + _ATTRIBUTES + ")?+(?:>|\\z)"


def _until_close(name: str) -> str:
    """Everything in front of the element's closing tag, or of the end of the text."""
    return f"(?:[^<]++|<(?!/{name}\\s*+>))*+"


# All patterns begin with "<": a page is mostly text, and one character test
# skips it.
RAW_CONTENT = (
    "(?i)<(?:!--(?:[^-]++|-(?!->))*+(?:-->)?+|"
    + "|".join(f"{n}{_TAIL}{_until_close(n)}(?:</{n}\\s*+>)?+" for n in RAW_ELEMENTS)
    + ")"
)
BODY = "(?is)<body" + _TAIL + "(.*)"
HEAD = "(?is)^.*</head\\s*+>"
TITLE = "(?i)<title" + _TAIL + _until_close("title") + "(?:</title\\s*+>)?+"
BODY_TAG = "(?i)<body[\\s/>]"
IMAGE = "(?i)<img" + _TAIL
HAS_IMAGE = "(?i)<img[\\s/>]"
INLINE_TAG = "(?i)</?+(?:" + "|".join(INLINE_ELEMENTS) + ")" + _TAIL
HIDDEN_OR_TAG = (
    "(?i)<(?:"
    + "|".join(f"{n}{_TAIL}{_until_close(n)}</{n}\\s*+>" for n in HIDDEN_ELEMENTS)
    + "|/?+[a-z]" + _ATTRIBUTES + "(?:>|\\z)"
    + "|[!?][^>]*+(?:>|\\z))"
)
ATTRIBUTE = "[^\\s\"'<>/=]++\\s*+=\\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\\s\"'>][^\\s>]*+)"


# Declared names of character sets, and the Java names that decode them.
CHARSETS = {
    "windows-1250": "windows-1250", "windows-1251": "windows-1251", "cp1251": "windows-1251",
    "windows-1253": "windows-1253", "windows-1254": "windows-1254", "iso-8859-9": "windows-1254",
    "windows-1255": "windows-1255", "windows-1256": "windows-1256", "windows-1257": "windows-1257",
    "windows-1258": "windows-1258", "windows-874": "x-windows-874", "tis-620": "x-windows-874",
    "iso-8859-2": "ISO-8859-2", "iso-8859-3": "ISO-8859-3", "iso-8859-4": "ISO-8859-4",
    "iso-8859-5": "ISO-8859-5", "iso-8859-6": "ISO-8859-6", "iso-8859-7": "ISO-8859-7",
    "iso-8859-8": "ISO-8859-8", "iso-8859-13": "ISO-8859-13", "iso-8859-15": "ISO-8859-15",
    "koi8-r": "KOI8-R", "koi8-u": "KOI8-U", "ibm866": "IBM866",
    "shift_jis": "windows-31j", "shift-jis": "windows-31j", "x-sjis": "windows-31j",
    "euc-jp": "EUC-JP", "iso-2022-jp": "ISO-2022-JP",
    "gb2312": "GBK", "gbk": "GBK", "gb18030": "GB18030", "big5": "Big5",
    "euc-kr": "x-windows-949", "ks_c_5601-1987": "x-windows-949",
}


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Expressions analysed inside may decode every set of the JVM, and replace damaged bytes.

    The session's own settings are as before afterwards; the expressions keep what they saw.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = [(name, spark.conf.get(name)) for name in names]
    try:
        for name in names:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before:
            spark.conf.set(name, value)


def decode_page(
    html_bytes: Column, content_type: Column | None = None, all_charsets: bool = False
) -> Column:
    """Bytes to text.

    The character set comes from a byte-order mark, else from the response header, else
    from the page's own ``<meta>`` declaration wherever it stands, else it is UTF-8 or, with
    ``all_charsets`` and bytes that are not UTF-8, the set that explains them best.
    Western single-byte sets all read as windows-1252; invalid sequences become replacement
    characters, so no page can raise.  ``all_charsets`` adds the sets of ``CHARSETS`` and
    UTF-16; the column must then be analysed inside ``java_charsets``.
    """
    bytewise = F.decode(html_bytes, "ISO-8859-1")
    declared = F.regexp_extract(
        bytewise, "(?i)<meta\\s[^>]*?charset\\s*=\\s*[\"']?\\s*([a-z0-9_:-]+)", 1
    )
    if content_type is not None:
        header = F.regexp_extract(
            F.coalesce(content_type, F.lit("")), "(?i)charset\\s*=\\s*[\"']?\\s*([a-z0-9_:-]+)", 1
        )
        declared = F.when(header != "", header).otherwise(declared)
    western = F.lower(declared).rlike("^(?:iso-?8859-1|iso_8859-1|latin-?1|us-ascii|windows-1252|cp-?1252)$")
    codes = [(chr(c), bytes([c]).decode("cp1252", errors="ignore")) for c in range(128, 160)]
    codes = [(code, char) for code, char in codes if char]
    single_byte = F.translate(
        F.decode(html_bytes, "ISO-8859-1"),
        "".join(code for code, _ in codes),
        "".join(char for _, char in codes),
    )
    unmarked = F.when(
        F.substring(html_bytes, 1, 3) == F.lit(b"\xef\xbb\xbf"), F.substring(html_bytes, 4, 2**31 - 1)
    )
    text = F.when(unmarked.isNotNull(), F.make_valid_utf8(unmarked.cast("string")))
    if all_charsets:
        known = F.create_map(*[F.lit(name) for pair in CHARSETS.items() for name in pair])
        other = F.try_element_at(known, F.lower(declared))
        wide = F.substring(html_bytes, 1, 2).isin(b"\xfe\xff", b"\xff\xfe")
        text = text.when(wide, F.call_function("decode", html_bytes, F.lit("UTF-16")))
        text = text.when(other.isNotNull(), F.call_function("decode", html_bytes, other))
        silent = (declared == "") & ~F.is_valid_utf8(html_bytes.cast("string"))
        guessed = F.call_function("decode", html_bytes, guessed_charset(html_bytes))
        text = text.when(silent, F.coalesce(guessed, F.make_valid_utf8(html_bytes.cast("string"))))
    return text.when(western, single_byte).otherwise(F.make_valid_utf8(html_bytes.cast("string")))


def drop_raw_content(html: Column) -> Column:
    """Remove comments and elements whose content is not markup, and stray anchor marks."""
    unmarked = F.replace(
        F.replace(html, F.lit(ANCHOR_START), F.lit("")), F.lit(ANCHOR_STOP), F.lit("")
    )
    return F.regexp_replace(unmarked, RAW_CONTENT, "")


def body_markup(clean_html: Column, implied_body: bool = True) -> Column:
    """Everything behind the ``<body>`` tag.

    The tag is optional in HTML: without one, the body is the page without its head and
    title, or null where ``implied_body`` is off.
    """
    explicit = F.when(clean_html.rlike(BODY_TAG), F.regexp_extract(clean_html, BODY, 1))
    if not implied_body:
        return explicit
    headless = F.regexp_replace(clean_html, HEAD, "")
    return F.coalesce(explicit, F.regexp_replace(headless, TITLE, ""))


def image_pieces(markup: Column) -> Column:
    """Markup cut in front of each image tag.

    The first piece has no image; every other one is a tag, ANCHOR_STOP, and the
    markup up to the next image.
    """
    fenced = F.regexp_replace(markup, IMAGE, f"{ANCHOR_START}$0{ANCHOR_STOP}")
    return F.split(fenced, ANCHOR_START, -1)


def _first_attribute(attributes: str, name: str) -> str:
    """SQL text: raw value of the first attribute of that name; null when absent."""
    found = f"get(filter({attributes}, a -> a rlike r'(?i)^{name}\\s*='), 0)"
    return (
        f"transform(array(regexp_replace({found}, r'^[^=]*=\\s*', '')),"
        f" v -> if(left(v, 1) in ('\"', '\\''), substring(v, 2, length(v) - 2), v))[0]"
    )


def image_anchors(pieces: str, max_images: int) -> Column:
    """Array of ``(pos, src, alt, kept)``, one entry per image of the column ``pieces``.

    The first ``max_images`` images count; of these, one without a source or
    with an inline ``data:image`` source is skipped.
    """
    pattern = ATTRIBUTE.replace("'", "\\x27")
    attributes = f"""transform(slice({pieces}, 2, size({pieces}) - 1), piece ->
        regexp_extract_all(substring_index(piece, '{ANCHOR_STOP}', 1), r'{pattern}', 0))"""
    values = f"""transform({attributes}, (attrs, pos) -> named_struct('pos', pos,
        'src', {_first_attribute('attrs', 'src')}, 'alt', coalesce({_first_attribute('attrs', 'alt')}, '')))"""
    return F.expr(f"""transform({values}, i -> named_struct('pos', i.pos, 'src', i.src, 'alt', i.alt,
        'kept', i.pos < {max_images} and coalesce(i.src <> '' and not startswith(i.src, 'data:image'), false)))""")


def mark_anchors(pieces: str, anchors: str) -> Column:
    """Markup with each kept image as a numbered mark and every other one as its alt text."""
    return F.expr(f"""concat({pieces}[0], array_join(
      zip_with({anchors}, slice({pieces}, 2, size({pieces}) - 1), (i, piece) -> concat(
        if(i.kept, concat('{ANCHOR_START}', i.pos, '{ANCHOR_STOP}'), replace(i.alt, '<', '&lt;')),
        substring_index(piece, '{ANCHOR_STOP}', -1))), ''))""")


def _drop_unclosed(markup: Column, name: str) -> Column:
    """Drop the opening tags of an element behind its last closing tag.

    No closing tag can be found for them, and each would be searched to the end of the page.
    """
    closing = f"</{name}>"

    def dropped(page: Column) -> Column:
        tail = F.substring_index(page, closing, -1)
        head = F.left(page, F.length(page) - F.length(tail))
        return F.concat(head, F.regexp_replace(tail, f"(?i)<{name}{_TAIL}", " "))

    def cleaned(page: Column) -> Column:
        uniform = F.regexp_replace(page, f"(?i)</{name}\\s*+>", closing)
        opened = page.rlike(f"(?i)<{name}[\\s/>]")
        return F.when(opened, F.transform(F.array(uniform), dropped)[0]).otherwise(page)

    # A variable of a lambda is computed once, however often it is used.
    return F.transform(F.array(markup), cleaned)[0]


def strip_tags(markup: Column) -> Column:
    """Visible text, still with character references and raw white space."""
    closed = F.regexp_replace(markup, INLINE_TAG, "")
    for name in HIDDEN_ELEMENTS:
        closed = _drop_unclosed(closed, name)
    return F.regexp_replace(closed, HIDDEN_OR_TAG, " ")


def context_windows(parts: str, anchors: str, max_chars: int) -> Column:
    """Array of ``(pos, src, alt, before, after)`` from the text split at ANCHOR_START.

    The text between two neighbouring marks is the second context of the first
    and the first context of the second.
    """

    def body(part: str) -> str:
        return f"btrim(substring_index({part}, '{ANCHOR_STOP}', -1))"

    anchor = f"get({anchors}, w.pos)"
    return F.expr(f"""
      transform(
        zip_with(slice({parts}, 1, size({parts}) - 1), slice({parts}, 2, size({parts}) - 1),
          (previous, current) -> named_struct(
            'pos', try_cast(substring_index(current, '{ANCHOR_STOP}', 1) as int),
            'before', substring({body('previous')}, -{max_chars}, {max_chars}),
            'after', substring({body('current')}, 1, {max_chars}))),
        w -> named_struct('pos', w.pos, 'src', {anchor}.src, 'alt', {anchor}.alt,
          'before', w.before, 'after', w.after))""")
