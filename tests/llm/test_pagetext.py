import random

from pairmine.llm import pagetext
from pairmine.llm.pagetext import Page, common_lines

from .helpers import with_clashes

PAGES = "page_id long, url string, html string"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_common_lines_are_a_longest_subsequence():
    chosen = random.Random(6)
    for _ in range(300):
        a = [chosen.choice("abcd") for _ in range(chosen.randint(0, 14))]
        b = [chosen.choice("abcd") for _ in range(chosen.randint(0, 14))]
        at = common_lines(a, b)
        assert at == sorted(set(at)) and len(at) == lcs(a, b)
        rest = iter(b)
        assert all(any(a[k] == x for x in rest) for k in at)


def test_regions():
    markup = """<!doctype html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href="/">Menu</a></li></ul></nav>
      <div class="ad">Buy</div><div id='cookie-notice'>We use</div><header>Site</header><!-- c <p>x</p> -->
      <article><header><h1>Title &amp; more</h1></header><p>One  two<br>three<p>Four &lt;b&gt; <b>bold <i>it</b>
      <script>var t="</p>";</script><aside>Side</aside><form><p>Your mail</p></form><div class="comments"><p>First!</p></div>
      <ul><li>item</li></ul></article><footer>&copy; x</footer></body>"""
    assert Page(1, "", "", "", markup).main_text(set()) == "Title & more\nOne two three\nFour <b> bold it\nitem"


def test_cut_and_odd_markup():
    for markup, text in [
        (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b</p", "a\nb"), ("<p>a<script>x", "a"), ("<p>1 < 2 &nbsp; 3", "1 < 2 3"),
        ("<article><p>a &am", "a &am"), ('<p title="a>b">c', "c"), ("<main>m</main><p>o", "m\no"), ("<p>x<!-- y", "x"),
    ]:
        assert Page(1, "", "", "", markup).main_text(set()) == text


def test_shared_lines_of_the_nearest_page_go(spark):
    rows = [
        (1, "http://h/a/1", "<div>Home of things</div><p>First text</p><div>All rights</div>"),
        (2, "http://h/a/2", "<div>Home of things</div><p>Second text</p><div>All rights</div>"),
        (3, "http://h/b/1", "<div>Other</div><p>Third text</p>"),
        (4, "http://k/a/1", "<div>Home of things</div>"),
        (5, "http://h/a/3", None), (5, "http://h/a/3", None), (None, None, "<p>no url</p>"),
    ]
    pages = with_clashes(spark.createDataFrame(rows, PAGES).coalesce(1), "host", "path", "text")
    got = sorted([(r.page_id, r.text) for r in pagetext.extract(pages).collect()], key=str)
    assert got == sorted([(1, "First text"), (2, "Second text"), (3, "Other\nThird text"), (4, "Home of things"), (5, ""), (5, ""), (None, "no url")], key=str)
    assert pagetext.extract(pages.limit(0)).count() == 0


def test_same_article_on_two_pages_stays(spark):
    rows = [(i, f"http://h/{i}", "<nav>N</nav><article><p>Shared story</p></article>") for i in range(4)]
    assert {r.text for r in pagetext.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"Shared story"}


def test_open_lines_beside_content_elements_are_differenced(spark):
    rows = [
        (1, "http://h/1", "<div>Site name</div><article><p>Teaser</p></article><div>First body</div><div>Imprint</div>"),
        (2, "http://h/2", "<div>Site name</div><article><p>Teaser</p></article><div>Second body</div><div>Imprint</div>"),
        (3, "http://k/1", "<main>Begin</main><p>and the rest"),
    ]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    got = {r.page_id: r.text for r in pagetext.extract(pages).collect()}
    assert got == {1: "Teaser\nFirst body", 2: "Teaser\nSecond body", 3: "Begin\nand the rest"}


def test_copies_do_not_wipe_each_other_out(spark):
    def markup(body):
        return f"<div>Site name</div>{body}<div>Imprint</div>"

    story = [f"Line {n} of a story that is told more than once" for n in range(12)]
    body = "".join(f"<p>{x}</p>" for x in story)
    changed = "".join(f"<p>{x}</p>" for x in [*story[:5], "A correction", *story[6:]])
    rows = [(1, "http://h/a/1", markup(body)), (1, "http://h/a/1", markup(body)), (2, "http://h/a/1?utm_source=x", markup(body))]
    rows += [(3, "http://h/a/2", markup(changed)), (4, "http://h/b/9", markup("<p>Something else</p>"))]
    rows += [(k, f"http://k/{k}", markup(body)) for k in (5, 6)]
    pages = spark.createDataFrame(rows, PAGES).coalesce(1)
    whole, other = "\n".join(story), "\n".join([*story[:5], "A correction", *story[6:]])
    alone = f"Site name\n{whole}\nImprint"
    expected = [(1, whole), (1, whole), (2, whole), (3, other), (4, "Something else"), (5, alone), (6, alone)]
    assert sorted((r.page_id, r.text) for r in pagetext.extract(pages).collect()) == expected


def test_a_long_run_of_copies_goes_through_a_file(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(pagetext, "_HELD", 3_000)
    rows = [(k, "", "h", f"/a/{k:03}", "<div>Site name</div><p>The story of all copies</p>") for k in range(50)]
    rows.append((50, "", "h", "/b", "<div>Site name</div><p>Quite another thing</p>"))
    names = ["page_id", "url", "host", "path", "html"]
    given = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    got = [tuple(r.values()) for b in pagetext._extract(iter([given])) for r in b.to_pylist()]
    assert got == [(k, "", "The story of all copies") for k in range(50)] + [(50, "", "Quite another thing")]


def test_article_text_stays_and_comments_go():
    for markup, text in [
        ('<article><h2 id="related-work">Related work</h2><p>a</article>', "Related work\na"),
        ('<article><section id="search"><p>a</section><section id="social-history"><p>b</section></article>', "a\nb"),
        ('<article><div class="article-header"><h1>T</h1></div><p>a</article>', "T\na"),
        ('<p>a</p><h3 class="menu-title">b</h3>', "a\nb"),
        ("<article><svg/><p>a</p><iframe src=x /><p>b</article>", "a\nb"),
        ("<p>a</p><script src=x /><p>b</p></script><p>c", "a\nc"),
        ('<article><p>a</article><article class="comment"><p>First!</article>', "a"),
        ('<main><p>a</p><ol class="commentlist"><li>First!</ol></main>', "a"),
        ('<main><p>a</p><div class="share">b</div><div class="sidebar">c</div></main>', "a"),
        ('<div id="sidebar">x</div><p>a', "a"),
    ]:
        assert Page(1, "", "", "", markup).main_text(set()) == text


def test_text_does_not_depend_on_the_dealing(spark, monkeypatch):
    monkeypatch.setattr(pagetext, "STRETCH_PAGES", 8)
    chosen = random.Random(12)
    rows = []
    for k in range(150):
        body = "".join(f"<p>{chosen.choice('abcdefgh')} {k if k % 5 else k // 25}</p>" for _ in range(3))
        rows.append((k % 140, f"http://{'hot' if k % 3 else chosen.choice('xyz')}/{chosen.choice('ab')}/{k // 4}", f"<div>Site name</div>{body}<div>Imprint</div>"))
    pages = spark.createDataFrame(rows, PAGES)
    results = []
    for parts in (1, 6, 24):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = pagetext.extract(pages.repartition(parts)).collect()
        results.append(sorted(tuple(r) for r in found))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert len(results[0]) == 150 and results[0] == results[1] == results[2]
    kept = sum("Site name" in r[2] for r in results[0])
    assert kept < 15
