"""Main text of pages, by differencing each page with the one nearest by URL.

A page becomes its lines: blocks of text with the region they stand in.  Pages are
sorted by host, path and id, and each is paired with the neighbour of its host whose
path shares more leading segments.  Copies are no neighbours, as they share the main
text: a run of pages that resemble its first one looks for partners before and behind the
run, and a page that finds none keeps its lines.  A longest common subsequence aligns the lines
of the two pages, and lines that both have are deleted.  Lines inside ``<article>`` or
``<main>`` are content by the page's own word and are exempt from deletion: pages that
carry the same article would lose it.  All other lines stay only if the neighbour does
not share them, on pages with content elements, too.  Lines in menus, headers, footers,
sidebars, notices, adverts, forms and reader comments go in any case.

A host's pages are cut into stretches: a page whose hash says so opens one, about one in
``STRETCH_PAGES``, fewer in a very large table.  Pairs are sought inside a stretch, so the
first and the last run of a stretch have one side to choose from, the text depends on the table
and not on how its rows are dealt, and a hot host spreads over many tasks.  A task holds some
pages and writes a longer run to a temporary file until the run ends.
"""

from __future__ import annotations

import html
import pickle
import re
import tempfile
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmine.llm.common import ship_code
from pairmine.llm.urlrules import host_of, path_of
from pairmine.session import stage

# Names of HTML elements by their role.
RAW = ("script", "style", "template", "noscript", "textarea", "title", "svg", "math", "iframe", "object")
BOILERPLATE = ("nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head")
CONTENT = ("article", "main")
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
    "s samp small span strike strong sub sup time tt u var wbr br"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
#: Words in a class, id or role that mark a region as boilerplate.
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|popup|modal|"
    r"nav\w*|menu|breadcrumbs?|sidebar|aside|footer|header|masthead|comments?|commentlist|replies|disqus|"
    r"share|social|related|newsletter|subscribe|search|contentinfo|complementary)(?:$|[\s_-])",
    re.IGNORECASE,
)
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
#: The same inside a content element, where ids and some words are the author's own.
_MARKED_INSIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|popup|modal|"
    r"nav\w*|menu|breadcrumbs?|sidebar|footer|comments?|commentlist|replies|disqus|"
    r"share|social|related|newsletter|subscribe)(?:$|[\s_-])",
    re.IGNORECASE,
)
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|replies|reply|disqus)(?:$|[\s_-])", re.IGNORECASE)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.IGNORECASE)
_SPACE = re.compile(r"[ \t\n\r\f\v ]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
#: Raw elements that end at once if their tag says so; the others run to their end tag.
_MAY_BE_EMPTY = ("svg", "math", "iframe", "object", "template", "noscript")
OPEN, CLOSED, KEPT = 0, 1, 2
#: Pages of a stretch, and stretches of a table, on average.
STRETCH_PAGES, MOST_STRETCHES = 512, 20_000
#: Pages are copies if their lines outside boilerplate share this part of their characters.
COPY_NUMERATOR, COPY_DENOMINATOR = 4, 5
#: Characters of a run that are held before they go to a file.
_HELD = 8_000_000
_BROADCAST_BYTES = 16 << 20


class Page:
    """Lines of a page and, for each, whether it is open, boilerplate or content."""

    __slots__ = ("page_id", "url", "host", "path", "lines", "regions")

    def __init__(self, page_id, url, host: str, path: str, markup: str | None):
        self.page_id, self.url, self.host, self.path = page_id, url, host, path
        self.lines: list[str] = []
        self.regions: list[int] = []
        self._read(markup or "")

    def _read(self, markup: str) -> None:
        stack: list[tuple[str, int]] = []
        region, held, at = OPEN, [], 0

        def close_block():
            if held:
                line = _SPACE.sub(" ", html.unescape("".join(held))).strip()
                held.clear()
                if line:
                    self.lines.append(line)
                    self.regions.append(region)

        while True:
            tag = _TAG.search(markup, at)
            text = markup[at : tag.start() if tag else len(markup)]
            if text:
                held.append(text)
            if not tag:
                break
            at = tag.end()
            if not tag[2]:
                continue
            name = tag[2].lower()
            if name == "br":
                held.append(" ")
                continue
            if name in INLINE or name in VOID:
                if name not in INLINE:
                    close_block()
                continue
            if name in RAW:
                close_block()
                if not tag[1] and not (name in _MAY_BE_EMPTY and tag[3].endswith("/")):
                    end = _RAW_END[name].search(markup, at)
                    at = end.end() if end else len(markup)
                continue
            close_block()
            if tag[1]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        region = stack[k][1]
                        del stack[k:]
                        break
            elif name != "p" and not tag[3].endswith("/"):
                stack.append((name, region))
                region = self._enter(name, tag[3], region)
        close_block()

    @staticmethod
    def _enter(name: str, attributes: str, region: int) -> int:
        if region == CLOSED:
            return CLOSED
        named = [(kind.lower(), value.strip("\"'")) for kind, value in _NAMED.findall(attributes)] if attributes else []
        if name in CONTENT:
            return CLOSED if any(_COMMENTS.search(v) for kind, v in named if kind == "class") else KEPT
        if name in BOILERPLATE and not (name == "header" and region == KEPT):
            return CLOSED
        if name in HEADINGS or name in ("html", "body"):
            return region
        if region == KEPT:
            return CLOSED if any(_MARKED_INSIDE.search(v) for kind, v in named if kind != "id") else KEPT
        return CLOSED if any(_MARKED.search(v) for _, v in named) else region

    def main_text(self, shared: set[int]) -> str:
        """The content lines and the open lines that no neighbour shares, in page order."""
        return "\n".join(
            x
            for k, (x, r) in enumerate(zip(self.lines, self.regions, strict=True))
            if r == KEPT or (r == OPEN and k not in shared)
        )

    def outside(self) -> list[int]:
        """Numbers of the lines that may be deleted."""
        return [k for k, r in enumerate(self.regions) if r != KEPT]


def common_lines(mine: list[str], other: list[str]) -> list[int]:
    """Places in ``mine`` of a longest common subsequence of the two."""
    head = 0
    while head < min(len(mine), len(other)) and mine[head] == other[head]:
        head += 1
    tail = 0
    while tail < min(len(mine), len(other)) - head and mine[-1 - tail] == other[-1 - tail]:
        tail += 1
    places: dict[str, list[int]] = {}
    for j in range(len(other) - tail - 1, head - 1, -1):
        places.setdefault(other[j], []).append(j)
    # ends[n]: smallest place in ``other`` at which a subsequence of n + 1 lines can end.
    ends: list[int] = []
    links: list[tuple | None] = []
    for i in range(head, len(mine) - tail):
        for j in places.get(mine[i], ()):
            n = bisect_left(ends, j)
            link = (i, links[n - 1] if n else None)
            if n == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[n]:
                ends[n], links[n] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(mine) - tail, len(mine))]


def _nearness(a: Page, b: Page | None) -> int:
    """Leading path segments two pages of a host share; -1 for other hosts."""
    if b is None or a.host != b.host:
        return -1
    shared = 0
    for x, y in zip(a.path.split("/"), b.path.split("/"), strict=False):
        if x != y:
            break
        shared += 1
    return shared


def _is_copy(a: Page, b: Page) -> bool:
    """Whether the lines outside boilerplate are all or nearly all the same."""
    mine, other = ([x for x, r in zip(p.lines, p.regions, strict=True) if r != CLOSED] for p in (a, b))
    if mine == other:
        return True
    both = sum(len(x) * n for x, n in (Counter(mine) & Counter(other)).items())
    either = sum(map(len, mine)) + sum(map(len, other)) - both
    return COPY_DENOMINATOR * both >= COPY_NUMERATOR * either


class _Run:
    """Pages in a row of one host that are copies of the first one."""

    def __init__(self, first: Page, last: _Run | None):
        self.first = self.last = first
        #: Pages that end and begin the runs before, nearest first.
        self.before: list[Page] = []
        if last and last.first.host == first.host:
            self.before = [last.last, last.first, *last.before[:2]]
        self._pages: list[Page] = []
        self._held = 0
        self._file = None
        self.add(first)

    def takes(self, page: Page) -> bool:
        return page.host == self.first.host and _is_copy(page, self.first)

    def add(self, page: Page) -> None:
        self.last = page
        self._pages.append(page)
        self._held += 1_000 + sum(map(len, page.lines))
        if self._held > _HELD:
            self._file = self._file or tempfile.TemporaryFile()
            for held in self._pages:
                pickle.dump((held.page_id, held.url, held.host, held.path, held.lines, held.regions), self._file)
            self._pages, self._held = [], 0

    def pages(self) -> Iterator[Page]:
        if self._file:
            self._file.seek(0)
            while True:
                try:
                    page_id, url, host, path, lines, regions = pickle.load(self._file)
                except EOFError:
                    break
                page = Page(page_id, url, host, path, None)
                page.lines, page.regions = lines, regions
                yield page
            self._file.close()
        yield from self._pages

    def finish(self, after: Page | None) -> Iterator[tuple]:
        behind = [after] if after and after.host == self.first.host else []
        for page in self.pages():
            before, follows = (next((p for p in side if not _is_copy(page, p)), None) for side in (self.before, behind))
            yield page.page_id, page.url, _finish(page, before, follows)


def _finish(page: Page, before: Page | None, after: Page | None) -> str:
    partner = before if _nearness(page, before) >= _nearness(page, after) else after
    shared: set[int] = set()
    if _nearness(page, partner) >= 0:
        mine = page.outside()
        same = common_lines([page.lines[k] for k in mine], [partner.lines[k] for k in partner.outside()])
        shared = {mine[k] for k in same}
    return page.main_text(shared)


def _extract(batches: Iterator[pa.RecordBatch]):
    names = ("page_id", "url", "host", "path", "html")
    out: list[tuple] = []

    def batch():
        columns = list(zip(*out, strict=True)) or [[], [], []]
        out.clear()
        kinds = (pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page_id", "url", "text"]
        )

    def finished():
        last: _Run | None = None
        for incoming in batches:
            columns = [incoming.column(incoming.schema.get_field_index(n)) for n in names]
            for row in zip(*columns, strict=True):
                page = Page(*[v.as_py() for v in row])
                if last and last.takes(page):
                    last.add(page)
                    continue
                if last:
                    yield from last.finish(page)
                last = _Run(page, last)
        if last:
            yield from last.finish(None)

    held = 0
    for row in finished():
        out.append(row)
        held += len(row[2])
        if held > 4_000_000:
            yield batch()
            held = 0
    yield batch()


def _in_stretches(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``stretch``: how many pages of the host open a stretch up to this one.

    The openers are few, whatever the size of the table; each row finds its place among those of
    its host by bisection.
    """
    spacing = max(STRETCH_PAGES, keyed.count() // MOST_STRETCHES)
    opens = F.pmod(F.xxhash64("host", "path", "page_id"), F.lit(spacing)) == 0
    at = F.struct("path", "page_id")
    openers = keyed.filter(opens).groupBy(F.col("host").alias("of")).agg(F.array_sort(F.collect_set(at)).alias("openers"))
    openers = stage(openers, "page-openers")
    held = openers.agg(F.sum(F.expr("aggregate(openers, 0L, (n, o) -> n + length(o.path) + 32)"))).first()[0] or 0
    small = F.broadcast(openers) if held <= _BROADCAST_BYTES else openers
    steps = ", ".join(str(1 << k) for k in range(17, -1, -1))
    place = F.expr(
        f"aggregate(array({steps}), 0, (p, b) -> if(p + b <= size(openers) and openers[p + b - 1] <= at, p + b, p))"
    )
    joined = keyed.withColumn("at", at).join(small, keyed["host"] == F.col("of"), "left")
    return joined.withColumn("stretch", F.when(F.col("openers").isNull(), 0).otherwise(place)).drop("at", "of", "openers")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text; a null url has an empty host, which pairs with
    the like; repeated rows are pages of their own, other columns are ignored, and
    cut markup counts up to where it ends.
    """
    ship_code(pages.sparkSession)
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").alias("url"),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col("html").alias("html"),
    )
    # A stretch is a host of its own to what follows; the hashes put rows of one key in an order.
    stretched = _in_stretches(keyed)
    own = stretched.withColumn("host", F.concat_ws(" ", "host", "stretch"))
    order = [F.col("host"), F.col("path"), F.col("page_id"), F.xxhash64("url"), F.xxhash64("html")]
    dealt = own.repartition("host").sortWithinPartitions(*order).drop("stretch")
    return dealt.mapInArrow(_extract, "page_id long, url string, text string")
