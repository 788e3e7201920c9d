"""Crawl records to page text: admission, decoding, quarantine, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.functions import markup
from pairmine.operators.barrier import drop_nulls


def is_html_response(content_type: Column) -> Column:
    return F.coalesce(F.lower(content_type).startswith("text/html"), F.lit(False))


def is_admitted(min_bytes: int = settings.MIN_RECORD_BYTES) -> Column:
    """Tests of the headers and the length; the payload is not read."""
    return (
        F.coalesce(F.col("http_parsed"), F.lit(False))
        & is_html_response(F.col("content_type"))
        & (F.col("content_length") >= min_bytes)
    )


def admit_pages(
    records: DataFrame, min_bytes: int = settings.MIN_RECORD_BYTES, read_payload: bool = True
) -> DataFrame:
    """Keep parsed HTML responses of at least ``min_bytes`` with a URL and a payload.

    Without ``read_payload`` the stated length decides, and the scan can leave the pages out.
    """
    payload = F.length("html_bytes") if read_payload else F.col("content_length")
    kept = records.filter((F.col("page_url") != "") & (payload > 0))
    if "media_type" in records.columns:
        # Plain comparisons, which a source can take over.
        kind = F.col("media_type").startswith("text/html")
        return kept.filter(F.col("http_parsed") & kind & (F.col("content_length") >= min_bytes))
    return kept.filter(is_admitted(min_bytes))


def decode_pages(records: DataFrame) -> DataFrame:
    """Replace ``html_bytes`` by the text column ``html``."""
    html = markup.decode_page(F.col("html_bytes"), F.col("content_type"), all_charsets=True)
    with markup.java_charsets(records.sparkSession):
        return records.withColumn("html", html).drop("html_bytes")


def page_bodies(pages: DataFrame, implied_body: bool = True) -> DataFrame:
    """Pages with their body markup in ``body``; undecodable pages are dropped, and
    pages without a ``<body>`` tag where ``implied_body`` is off."""
    clean = pages.withColumn("clean", markup.drop_raw_content(F.col("html")))
    bodies = clean.withColumn("body", markup.body_markup(F.col("clean"), implied_body))
    return drop_nulls(bodies.drop("clean"), "body")


def judge_records(records: DataFrame, min_bytes: int = settings.MIN_RECORD_BYTES) -> DataFrame:
    """Records with ``html`` instead of the payload, and ``reason``: why one cannot yield any context.

    The tests read the header columns first; only records that pass them are decoded.
    """
    html = F.col("html")
    damage = F.col("damage") if "damage" in records.columns else F.lit(None).cast("string")
    header_reason = (
        F.when(damage.isNotNull(), F.concat(F.lit("damaged: "), damage))
        .when(~F.coalesce(F.col("http_parsed"), F.lit(False)), "no_http_headers")
        .when(F.coalesce(F.col("content_type"), F.lit("")) == "", "no_content_type")
        .when(~is_html_response(F.col("content_type")), "not_html")
        .when(F.coalesce(F.col("content_length"), F.lit(0)) < min_bytes, "too_short")
        .when(F.coalesce(F.length("html_bytes"), F.lit(0)) == 0, "empty_payload")
    )
    page_reason = (
        F.when(F.coalesce(F.col("page_url"), F.lit("")) == "", "no_page_url")
        .when(~F.coalesce(html.rlike(markup.HAS_IMAGE), F.lit(False)), "no_image_tag")
    )
    judged = records.withColumn("header_reason", header_reason)
    text = markup.decode_page(F.col("html_bytes"), F.col("content_type"), all_charsets=True)
    with markup.java_charsets(records.sparkSession):
        decoded = judged.withColumn("html", F.when(F.col("header_reason").isNull(), text))
    reason = F.coalesce(F.col("header_reason"), page_reason)
    return decoded.select("warc_path", "record_offset", "page_url", "html", reason.alias("reason"))


def quarantine(records: DataFrame, min_bytes: int = settings.MIN_RECORD_BYTES) -> DataFrame:
    """Records that cannot yield any context, with the reason."""
    return drop_nulls(judge_records(records, min_bytes).drop("html"), "reason")


def is_damaged(records: DataFrame) -> Column:
    """The row stands for something in the archive that is no record."""
    return F.col("damage").isNotNull() if "damage" in records.columns else F.lit(False)


def ingest_counters(
    records: DataFrame,
    extracted: DataFrame,
    kept: DataFrame,
    min_bytes: int = settings.MIN_RECORD_BYTES,
) -> DataFrame:
    """One row: records, damaged places, HTML responses, parsed pages, extracted, added and marked contexts."""
    scanned = records.agg(
        F.count_if(~is_damaged(records)).alias("records"),
        F.count_if(is_damaged(records)).alias("damaged"),
        F.count_if(is_admitted(min_bytes)).alias("html_responses"),
        F.count_if(is_admitted(min_bytes) & (F.col("content_length") > 0)).alias("parsed_pages"),
    )
    added = kept.agg(
        F.struct(
            F.count(F.lit(1)).alias("contexts_added"),
            F.count_if(F.col("is_training_candidate")).alias("contexts_marked"),
        ).alias("added")
    )
    found = extracted.agg(F.count(F.lit(1)).alias("contexts_found"))
    return scanned.select(
        "*", found.scalar().alias("contexts_found"), added.scalar().alias("added")
    ).select(*scanned.columns, "contexts_found", "added.*")
