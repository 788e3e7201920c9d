"""Pages to image contexts, in one narrow stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.functions import markup, text, urls

# Columns that identify where a context was found.
ORIGIN = ["warc_path", "record_offset", "page_url"]


def alt_in_context(
    alt: Column, before: Column, after: Column, min_alt_chars: int = settings.MIN_ALT_CHARS
) -> Column:
    """The alt text is long enough and occurs, loosely, in the surrounding text."""
    wanted = text.normalize_text(alt)
    context = text.normalize_text(F.concat(before, F.lit(" "), after))
    found = (F.length(alt) >= min_alt_chars) & (wanted != "") & F.contains(context, wanted)
    return F.coalesce(found, F.lit(False))


def enough_words(before: Column, after: Column, min_words: int) -> Column:
    return text.has_words(F.concat(before, F.lit(" "), after), min_words)


def anchored_pages(
    pages: DataFrame,
    max_images: int = settings.MAX_IMAGES_PER_PAGE,
    implied_body: bool = True,
) -> DataFrame:
    """Pages with ``anchors`` (one entry per image) and ``marked`` (markup with image marks).

    Both are null for a page without an image tag or a body: such a page is not
    touched by any further expression, and gives no row later.  It is not
    filtered out here, because the optimizer would push the filter down and with
    it a second copy of whatever made ``html``.  Each step is its own
    projection, because a column that the next one uses more than once must be
    computed only once.
    """
    has_image = F.col("html").rlike(markup.HAS_IMAGE)
    clean = F.when(has_image, markup.drop_raw_content(F.col("html")))
    bodies = pages.withColumn("clean", clean).drop("html")
    markup_body = bodies.withColumn(
        "body", markup.body_markup(F.col("clean"), implied_body)
    ).drop("clean")
    pieces = markup_body.withColumn("pieces", markup.image_pieces(F.col("body"))).drop("body")
    anchored = pieces.withColumn("anchors", markup.image_anchors("pieces", max_images))
    return anchored.withColumn("marked", markup.mark_anchors("pieces", "anchors")).drop("pieces")


def page_texts(anchored: DataFrame) -> DataFrame:
    """Adds ``page_text``: visible text of the body, with the image marks in it, or null."""
    stripped = anchored.withColumn("stripped", markup.strip_tags(F.col("marked"))).drop("marked")
    decoded = stripped.withColumn("decoded", text.decode_entities("stripped"))
    return decoded.withColumn(
        "page_text", text.collapse_whitespace(F.col("decoded"))
    ).drop("stripped", "decoded")


def image_windows(
    anchored_texts: DataFrame, max_context_chars: int = settings.MAX_CONTEXT_CHARS, tag: str | None = None
) -> DataFrame:
    """One row per kept image with the text on both sides of it.

    A page without an image gives no row, or one if its column ``tag`` is set.
    """
    parts = anchored_texts.withColumn(
        "parts", F.split("page_text", markup.ANCHOR_START, -1)
    ).drop("page_text")
    windows = parts.withColumn(
        "windows", markup.context_windows("parts", "anchors", max_context_chars)
    )
    # The outer form: the plain one would make the optimizer test the array's
    # size in a copy of the whole expression below.
    exploded = windows.select(*_origin(anchored_texts), F.explode_outer("windows").alias("w"))
    return exploded.filter(_or_tagged(F.col("w").isNotNull(), tag)).select(
        *_origin(anchored_texts),
        F.col("w.pos").alias("img_pos"),
        F.col("w.src").alias("src"),
        F.col("w.alt").alias("raw_alt"),
        F.col("w.before").alias("context_before"),
        F.col("w.after").alias("context_after"),
    )


def _or_tagged(condition: Column, tag: str | None) -> Column:
    return condition if tag is None else condition | F.col(tag).isNotNull()


def _origin(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("anchors", "page_text", "parts", "windows")]


def extract_contexts(
    pages: DataFrame,
    min_alt_chars: int = settings.MIN_ALT_CHARS,
    max_images: int = settings.MAX_IMAGES_PER_PAGE,
    min_context_words: int = settings.MIN_CONTEXT_WORDS,
    max_context_chars: int = settings.MAX_CONTEXT_CHARS,
    implied_body: bool = True,
    tag: str | None = None,
) -> DataFrame:
    """Image contexts of pages ``(…origin columns, page_url, html)``.

    Adds ``img_pos, image_url, alt_text, context_before, context_after,
    found_alt_in_context``; the origin columns pass through.  No shuffle.

    With ``tag``, the pages on which that origin column is set come along, too: one row each,
    without a context.  Their ``html`` must be null.
    """
    anchored = anchored_pages(pages, max_images, implied_body).withColumn(
        "page_parts", urls.url_parts("page_url")
    )
    windows = image_windows(page_texts(anchored), max_context_chars, tag)
    before, after = F.col("context_before"), F.col("context_after")
    enough = windows.filter(_or_tagged(enough_words(before, after, min_context_words), tag))
    decoded = enough.withColumns(
        {
            "src": text.decode_entities("src", in_attribute=True),
            "alt_text": text.decode_entities("raw_alt", in_attribute=True),
        }
    ).drop("raw_alt")
    return decoded.withColumns(
        {
            "image_url": urls.resolve_url("page_url", "src", "page_parts"),
            "found_alt_in_context": alt_in_context(
                F.col("alt_text"), before, after, min_alt_chars
            ),
        }
    ).drop("src", "page_parts")
