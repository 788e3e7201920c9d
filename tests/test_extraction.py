import random

import pytest
from pyspark.sql import functions as F

from pairmine.functions import markup, text
from pairmine.operators import contexts, pages


def extract(spark, html, url="http://example.com/page", **limits):
    df = spark.createDataFrame([(url, html)], "page_url string, html string")
    limits = {"min_alt_chars": 10, "min_context_words": 5, **limits}
    return contexts.extract_contexts(df, **limits).orderBy("img_pos").collect()


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


def test_alt_only_in_attribute(spark):
    rows = extract(
        spark,
        page(
            "<p>Some text before the image.</p>"
            '<img src="image1.jpg" alt="A unique description only in alt."/>'
            "<p>Some text after the image.</p>"
        ),
    )
    assert len(rows) == 1
    assert rows[0].image_url == "http://example.com/image1.jpg"
    assert rows[0].context_before == "Some text before the image."
    assert rows[0].context_after == "Some text after the image."
    assert rows[0].found_alt_in_context is False


def test_alt_in_text(spark):
    alt = "The specific description is here."
    rows = extract(
        spark, page(f'<p>Text before. {alt} More.</p><img src="i.png" alt="{alt}"/><p>Text after.</p>')
    )
    assert [r.found_alt_in_context for r in rows] == [True]


def test_alt_in_text_normalised(spark):
    rows = extract(
        spark,
        page(
            "<p>Before... description with title case and punctuation ...more text.</p>"
            '<img src="i.gif" alt="Description with Title Case and Punctuation!"/><p>After.</p>'
        ),
    )
    assert [r.found_alt_in_context for r in rows] == [True]


def test_no_image(spark):
    assert extract(spark, page("<p>Just text.</p>")) == []


def test_missing_and_short_alt(spark):
    rows = extract(spark, page('<p>Before</p><img src="/images/pic.png"/><p>After</p>'), min_context_words=1)
    assert [(r.alt_text, r.found_alt_in_context) for r in rows] == [("", False)]
    rows = extract(
        spark, page('<p>Before short</p><img src="s.gif" alt="short"><p>After</p>'), min_context_words=1
    )
    assert [(r.alt_text, r.found_alt_in_context) for r in rows] == [("short", False)]


def test_neighbours_share_the_text_between_them(spark):
    alt2 = "Alt text for second image also in text"
    rows = extract(
        spark,
        page(
            '<h1>Title</h1><p>Text A</p><img src="1.png" alt="Alt text for first image unique">'
            f'<p>Text B mentions: {alt2}.</p><img src="2.jpg" alt="{alt2}"><p>Text C</p>'
        ),
        min_context_words=1,
    )
    assert [r.found_alt_in_context for r in rows] == [False, True]
    assert rows[0].context_before == "Title Text A"
    assert rows[0].context_after == rows[1].context_before == f"Text B mentions: {alt2}."
    assert rows[1].context_after == "Text C"


def test_word_minimum(spark):
    html = page('<p>Short</p><img src="i.png" alt="Valid alt text here"><p>Context</p>')
    assert extract(spark, html, min_context_words=5) == []
    assert len(extract(spark, html, min_context_words=2)) == 1


def test_skipped_images_stay_as_alt_text_and_keep_the_others_aligned(spark):
    rows = extract(
        spark,
        page(
            '<img src="data:image/png;base64,x" alt="inline">one<img alt="no source">two'
            '<img src="" alt="empty">three<img src="a.png">four'
        ),
        min_context_words=1,
    )
    assert [r.img_pos for r in rows] == [3]
    assert rows[0].context_before == "inlineoneno sourcetwoemptythree"
    assert rows[0].context_after == "four"


def test_cap_counts_skipped_images(spark):
    images = "".join(f'w{i} <img src="{i}.png" alt="alt{i}">' for i in range(25))
    rows = extract(spark, page(images + " end"), min_context_words=1)
    assert [r.img_pos for r in rows] == list(range(20))
    assert rows[-1].context_after == "w20 alt20w21 alt21w22 alt22w23 alt23w24 alt24 end"
    with_skip = page('<img src="data:image/x">' + images)
    assert len(extract(spark, with_skip, min_context_words=1)) == 19


def test_contexts_are_cut_at_the_image(spark):
    rows = extract(
        spark, page("a" * 3000 + " b" + '<img src="i">' + "c " + "d" * 3000), min_context_words=1
    )
    assert rows[0].context_before == "a" * 2498 + " b"
    assert rows[0].context_after == "c " + "d" * 2498


def test_markup_that_is_no_content(spark):
    rows = extract(
        spark,
        page(
            '<script>var x = "<img src=no.png>";</script><style>p{}</style><!-- <img src="c"> -->'
            '<textarea><img src="t"></textarea><noscript><img src="n" alt="x"> hidden</noscript>'
            "<p title='a > b'>H<sub>2</sub>O &amp;lt; caf&eacute; &#233;&#xE9; &#150;</p>"
            "<button>Press</button><IMG data-src='q' SRC = im.png ALT='it&quot;s'>End<a href=\"cut"
        ),
        min_context_words=1,
    )
    assert len(rows) == 1
    assert rows[0].context_before == "H2O &lt; café éé –"
    assert rows[0].context_after == "End"
    assert (rows[0].image_url, rows[0].alt_text) == ("http://example.com/im.png", 'it"s')


def test_pathological_markup_neither_overflows_nor_backtracks(spark):
    many = " ".join(f"a{i}='x'" for i in range(50_000))
    html = [
        page(f"one <b {many}>two</b> <img src='i.png'> three"),
        page("one <img src='i.png'> three <p " + 'x="y ' * 30_000),
        page("<img src='i.png'> one " + "<!-- " * 30_000),
        page("<img src='i.png'> one " + "<script" * 30_000),
        "<body>" + "<" * 200_000 + "<img src='i.png'> one",
    ]
    df = spark.createDataFrame([("http://e.com/", h) for h in html], "page_url string, html string")
    assert contexts.extract_contexts(df, min_context_words=1).count() == 5


def test_anchor_marks_in_the_input_are_harmless(spark):
    rows = extract(spark, page("a \u00010\u0002 &#1;5&#2; b<img src='i.png'>c"), min_context_words=1)
    assert [r.context_before for r in rows] == ["a 0 5 b"]


def test_body_rule(spark):
    html = "<html><p>text</p><img src='i.png'>more</html>"
    assert extract(spark, html, min_context_words=1, implied_body=False) == []
    assert [r.context_before for r in extract(spark, html, min_context_words=1)] == ["text"]
    headed = "<title>T</title><head><title>U</title></head><p>text</p><img src='i.png'>more"
    assert [r.context_before for r in extract(spark, headed, min_context_words=1)] == ["text"]
    headless = "<title>T</title><p>text</p><img src='i.png'>more"
    assert [r.context_before for r in extract(spark, headless, min_context_words=1)] == ["text"]


def test_character_references(spark):
    import html

    texts = [
        "&&#97;mp; &l&#116;; &lt;", "&#0000000000233; &#x000000E9; &#233 x", "&nbsp|&copy 2020|&copy2020",
        "&lpar;&NotEqual;&notit;&notin;", "&unknown; & &; &# &#x &#xZ", "&#150;&#x80;", "&amp;lt; &amp;amp;",
        "&#99999999999999999999;&#xD800;", "a & b && c", "", "&", "&AMP&LT;", "&CounterClockwiseContourIntegral;",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in df.select(text.decode_entities("t")).collect()]
    assert found == [html.unescape(t) for t in texts]
    src = spark.createDataFrame([("?a=1&copy=2&copy;&lt&reg3",)], "t string")
    assert src.select(text.decode_entities("t", in_attribute=True)).first()[0] == "?a=1&copy=2©<&reg3"


@pytest.mark.parametrize("tag", ["label", "button", "select", "noscript"])
def test_unclosed_hidden_elements_take_linear_time(spark, tag):
    import time

    def took(element):
        body = "<img src='i.png'> start " + f"<{element} a='b'>word " * 40_000
        begin = time.time()
        rows = extract(spark, page(body), min_context_words=1, max_context_chars=10**6)
        assert rows[0].context_after == "start" + " word" * 40_000
        return time.time() - begin

    took("p")
    assert took(tag) < 5 * took("p") + 2


def test_hidden_elements_closed_and_unclosed(spark):
    body = "<img src='i'>a <LABEL>x</Label >b <label>c <button>y</button> <label>z</label> d <label>e"
    rows = extract(spark, page(body), min_context_words=1)
    assert rows[0].context_after == "a b d e"


def test_many_references_take_linear_time(spark):
    import time

    body = "<img src='i.png'>" + "".join(f"&#{n};" for n in range(20_000, 50_000))
    begin = time.time()
    rows = extract(spark, page(body), min_context_words=1)
    assert rows[0].context_after.startswith("".join(map(chr, range(20_000, 20_100))))
    assert time.time() - begin < 5

def test_result_does_not_depend_on_partitions(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        parts = [f"<p>{' '.join(rng.choice('abcdefgh') * 3 for _ in range(8))}</p>" for _ in range(6)]
        parts.insert(rng.randrange(6), f'<img src="{i % 7}.png" alt="{"x" * (i % 20)}">')
        rows.append((f"http://e.com/{i % 9}", page("".join(parts))))
    df = spark.createDataFrame(rows, "page_url string, html string")
    one = contexts.extract_contexts(df.coalesce(1), min_context_words=1).collect()
    many = contexts.extract_contexts(df.repartition(13), min_context_words=1).collect()
    assert sorted(one) == sorted(many)


def test_has_words_agrees_with_word_count(spark):
    texts = ["", "a", "a b", "é_1, b.c", " x  y z ", "don't stop", "a " * 100]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (0, 1, 2, 3, 100, 101):
        same = df.select((text.has_words(F.col("t"), n) == (text.word_count(F.col("t")) >= n)).alias("ok"))
        assert all(r.ok for r in same.collect())


@pytest.mark.parametrize(
    "raw, expected",
    [(None, ""), ("", ""), ("  A,  b!\tC d ", "a b c d"), ("it's #1", "its 1"), ("ÄÖ-ß", "äöß")],
)
def test_normalize(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.normalize_text(F.col("t"))).first()[0] == expected


def test_decode_page(spark):
    rows = [
        ("é ü".encode(), "text/html"),
        ("é ü".encode("latin-1"), "text/html; charset=ISO-8859-1"),
        (b'<meta charset="latin1">' + "é ü".encode("latin-1"), "text/html"),
        (b"bad \xff\xfe bytes", None),
        ("it’s – 5 €".encode("cp1252"), "text/html; charset=windows-1252"),
    ]
    df = spark.createDataFrame(rows, "b binary, c string")
    out = [r[0] for r in df.select(markup.decode_page(F.col("b"), F.col("c"))).collect()]
    assert out[0] == out[1] == "é ü"
    assert out[2].endswith("é ü")
    assert out[4] == "it’s – 5 €"
    assert out[3].startswith("bad ") and out[3].endswith(" bytes")


# Sentences that no list of frequent letters was made from, by the sets that write them.
SENTENCES = {
    "Вчера вечером мы долго гуляли по набережной, потом зашли в маленькое кафе.": "cp1251 koi8_r iso8859_5 cp866",
    "Стара бібліотека зачинена на ремонт до кінця місяця.": "cp1251 koi8_u",
    "Die Bäume blühen schon, aber über den Hügeln liegt noch früh der weiße Nebel.": "cp1252",
    "Le théâtre était fermé, nous avons donc dîné près de la forêt où naît le ruisseau.": "cp1252",
    "El niño pequeño comió una piña en la montaña y después durmió más de una hora.": "cp1252",
    "Zażółcone liście spadały wolno na ścieżkę, gdy wiał północny wiatr.": "cp1250 iso8859_2",
    "Příliš žluťoučký kůň běžel přes zelenou louku až k řece.": "cp1250 iso8859_2",
    "Çocuklar bahçede oynarken güneş yavaşça dağın ardında kayboldu, ışık söndü.": "cp1254",
    "Το παλιό λιμάνι γεμίζει κάθε πρωί με βάρκες και φωνές ψαράδων.": "cp1253",
    "הספרייה הישנה סגורה היום אבל הגן פתוח לכל המבקרים עד הערב": "cp1255",
    "المكتبة القديمة مغلقة اليوم لكن الحديقة مفتوحة للزوار حتى المساء": "cp1256",
    "ห้องสมุดเก่าปิดวันนี้แต่สวนสาธารณะเปิดให้เข้าชมจนถึงเย็น": "cp874",
    "昨日の夜、私たちは海辺を長く歩いてから、小さな喫茶店に入りました。": "cp932 euc_jp",
    "图书馆今天关门了，但是花园一直开放到晚上，我们可以在那里看书。": "gb18030",
    "圖書館今天關門了，但是花園一直開放到晚上，我們可以在那裡看書。": "big5",
    "오래된 도서관은 오늘 문을 닫았지만 정원은 저녁까지 방문객에게 열려 있습니다.": "euc_kr",
}


def test_undeclared_character_sets(spark):
    wrap = '<html><head><title>x</title></head><body class="a"><p>{}</p><img src="/a.png" alt="b"></body></html>'
    rows = [(wrap.format(t), codec) for t, codecs in SENTENCES.items() for codec in codecs.split()]
    data = [(i, t.encode(codec), "text/html") for i, (t, codec) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, html_bytes binary, content_type string").repartition(4)
    got = {r.i: r.html for r in pages.decode_pages(df).collect()}
    wrong = [(codec, got[i][50:90]) for i, (t, codec) in enumerate(rows) if got[i] != t]
    assert not wrong, wrong


def test_no_guess_without_reason(spark):
    import time

    cases = [
        (b"bad \xff\xfe bytes", None),
        ("Ünïcödé and дом and 日本".encode() + b"\xff", "Ünïcödé and дом and 日本\ufffd"),
        ("Ünïcödé".encode(), "Ünïcödé"),
        (b"", ""),
        (None, None),
        ("<meta charset=utf-8>дом".encode("cp1251"), None),
        (b"a" * 300_000 + "день ".encode("cp1251") * 60_000, "a" * 300_000 + "день " * 60_000),
        (b"\x81\xff" * 200_000, None),
    ]
    data = [(i, b, "text/html") for i, (b, _) in enumerate(cases)]
    df = spark.createDataFrame(data, "i int, html_bytes binary, content_type string")
    start = time.monotonic()
    got = {r.i: r.html for r in pages.decode_pages(df).collect()}
    assert time.monotonic() - start < 60
    for i, (b, text_) in enumerate(cases):
        assert got[i] == text_ if text_ is not None or b is None else "\ufffd" in got[i], i


def test_declared_character_sets(spark):
    texts = {
        "windows-1251": "Привет, мир", "koi8-r": "Привет", "iso-8859-2": "Żółć", "shift_jis": "日本語テスト",
        "gbk": "简体中文", "big5": "繁體中文", "euc-kr": "한국어", "euc-jp": "日本語",
    }
    rows = [(t.encode(name), f"text/html; charset={name.upper()}", t) for name, t in texts.items()]
    rows += [(f'<meta charset="{name}">'.encode() + t.encode(name), None, f'<meta charset="{name}">{t}')
             for name, t in texts.items()]
    rows += [
        ("é".encode("utf-8-sig"), "text/html; charset=iso-8859-1", "é"),
        ("é日".encode("utf-16"), "text/html", "é日"),
        (b"\xfe\xff" + "é日".encode("utf-16-be"), None, "é日"),
        ("é".encode(), "text/html; charset=no-such-set", "é"),
        (None, "text/html; charset=gbk", None),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, html_bytes binary, content_type string")
    decoded = pages.decode_pages(df)
    assert [r.html for r in decoded.orderBy("i").collect()] == [r[2] for r in rows]
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    damaged = spark.createDataFrame(
        [(0, "日本".encode("shift_jis") + b"\xff\x81", "text/html; charset=shift_jis")],
        "i int, html_bytes binary, content_type string",
    )
    assert pages.decode_pages(damaged).first().html.startswith("日本")


def _record(number, html=b"<body><img src='a'></body>".ljust(200), **changes):
    row = {
        "warc_path": "w", "record_offset": number, "page_url": "http://e.com/", "http_parsed": True,
        "content_type": "Text/HTML; charset=utf-8", "content_length": len(html or b""), "html_bytes": html,
        "media_type": None, "damage": None,
    }
    row |= changes
    kind = row["content_type"]
    return {**row, "media_type": kind and kind.lower().partition(";")[0].strip()}


def test_admission_and_quarantine(spark):
    from pairmine.schemas import CRAWL_RECORD

    rows = [
        _record(1),
        _record(2, http_parsed=False),
        _record(3, content_type=None),
        _record(4, content_type="image/png"),
        _record(5, html=b"<body><img src='a'>"),
        _record(6, html=b"", content_length=200),
        _record(7, page_url=None),
        _record(8, html=b"<body>no picture</body>".ljust(200)),
        _record(9, html=b"<img src='a'>".ljust(200)),
        _record(10, None, http_parsed=False, page_url=None, content_type=None, damage="cut off"),
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], CRAWL_RECORD)
    admitted = {r.record_offset for r in pages.admit_pages(df).collect()}
    assert admitted == {1, 8, 9}
    reasons = {r.record_offset: r.reason for r in pages.quarantine(df).collect()}
    assert reasons == {
        2: "no_http_headers", 3: "no_content_type", 4: "not_html", 5: "too_short",
        6: "empty_payload", 7: "no_page_url", 8: "no_image_tag", 10: "damaged: cut off",
    }
