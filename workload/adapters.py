"""The given tables shaped like this engine's inputs.

The tables hold no images, archives, logits or assets.  These adapters derive
them, whole table by whole table; ``oracle.py`` says the same in SQL.
"""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.operators import contexts as extraction
from pairmine.operators import enrichment, prediction, store, vocabulary
from pairmine.operators.skew import hot_keys
from pairmine.session import spread, work_path

MAX_LEN = settings.MAX_LEN

# Rewrites that put images of every kind into a page.
PAGE_REWRITES = [
    (
        "<h1>",
        "<img src='//cdn.example.org/h.png?v=1&amp;w=2' alt='headline art for this page'><h1>",
        "<img src='//cdn.example.org/h.png?v=1&amp;w=2' alt='headline art for this page'><h1>",
    ),
    (
        "<article>",
        '<article><noscript><img src="t.gif" alt="tracker"></noscript>',
        '<article><noscript><img src="t.gif" alt="tracker"></noscript>',
    ),
    ("<!-- ad ", '<!-- <img src="c.png" alt="hidden"> ad ', '<!-- <img src="c.png" alt="hidden"> ad '),
    (
        "<p><b>",
        '<img src="data:image/png;base64,AAAA" alt="an inline pixel"><p><b>',
        '<img src="data:image/png;base64,AAAA" alt="an inline pixel"><p><b>',
    ),
    (
        '<li><a href="/([^"<> ]*)">',
        '<li><img src=../icons/./$1.gif alt=go><a href="/$1">',
        '<li><img src=../icons/./\\1.gif alt=go><a href="/\\1">',
    ),
    (
        '<p>([^<>" ]+)( [^<>" ]+ [^<>" ]+ [^<>" ]+)',
        '<img src="/media/$1.jpg" alt="$1$2"><p>$1$2',
        '<img src="/media/\\1.jpg" alt="\\1\\2"><p>\\1\\2',
    ),
]

# References of every shape, for URL resolution.
REFERENCES = [
    "a.png", "./a.png", "../a.png", "../../../a.png", "a/../b/./c.png", "/root//x/../a.png",
    "//host.example.org/p/a.png", "?v=2", "#top", "", "HTTP://Other.example.org/A.png",
    "mailto:someone@example.org", "a b.png", "a.png?x=1#f", "d/", ".", "..", "d/..", "e//f.png",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def shape_pages(pages: DataFrame, crawl: int) -> DataFrame:
    """Pages with images.  The second crawl saw one more image on every page."""
    html = F.col("html")
    for pattern, replacement, _ in PAGE_REWRITES:
        html = F.regexp_replace(html, pattern, replacement)
    if crawl == 2:
        html = F.regexp_replace(html, "</h1>", '</h1><img src="late.webp" alt="">')
    return pages.select(
        F.lit(f"crawl-{crawl}.warc.gz").alias("warc_path"),
        F.col("page_id").alias("record_offset"),
        F.col("url").alias("page_url"),
        html.alias("html"),
    )


_written: dict[tuple, str] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A derived table, written once per application to the shared folder and read back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = work_path(spark, name)
        build().write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def image_pages(spark: SparkSession, sf_dir: str, crawl: int = 1) -> DataFrame:
    """The image pages of one crawl, written as a table of pages."""
    return written(
        spark, sf_dir, f"pages-{crawl}", lambda: shape_pages(table(spark, sf_dir, "pages"), crawl)
    )


def both_crawls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_pages(spark, sf_dir, 1).unionByName(image_pages(spark, sf_dir, 2))


def crawl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl records around the image pages, some not admissible, written as a table."""
    return written(spark, sf_dir, "records", lambda: _crawl_records(spark, sf_dir))


def _crawl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = image_pages(spark, sf_dir)
    n = F.col("record_offset")
    kind = (
        F.when(n % 11 == 1, F.lit(None).cast("string"))
        .when(n % 11 == 2, "")
        .when(n % 11 == 3, "application/json")
        .when(n % 11 == 4, "TEXT/HTML; charset=utf-8")
        .otherwise("text/html")
    )
    html = (
        F.when(n % 13 == 5, F.lit("<html><body>short</body></html>"))
        .when(n % 13 == 6, F.regexp_replace("html", "<body>", ""))
        .when(n % 13 == 7, F.regexp_replace("html", "<img", "<pic"))
        .otherwise(F.col("html"))
    )
    payload = html.cast("binary")
    return pages.select(
        "warc_path",
        "record_offset",
        "page_url",
        (n % 17 != 3).alias("http_parsed"),
        kind.alias("content_type"),
        F.length(payload).cast("bigint").alias("content_length"),
        payload.alias("html_bytes"),
        F.lower(F.substring_index(kind, ";", 1)).alias("media_type"),
        F.when(n % 19 == 7, "junk").alias("damage"),
    )


def _words(column: str):
    return F.filter(F.split(column, "[ \\t\\r\\n]+"), lambda w: w != "")


def _doc_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted contexts made of documents: every one crawled twice.

    The text before the image is the first half of the words, the text after it
    the second half; the alt text is words 3 to 7, or empty.  The texts are made before a row is doubled.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", _words("text").alias("words")
    )
    half = F.floor(F.size("words") / 2).cast("int")
    sides = docs.select(
        "*",
        F.array_join(F.slice("words", F.lit(1), half), " ").alias("context_before"),
        F.array_join(F.slice("words", half + 1, F.size("words")), " ").alias("context_after"),
        F.when(F.col("doc_id") % 17 == 0, "")
        .otherwise(F.array_join(F.slice("words", 3, 5), " "))
        .alias("alt_text"),
    ).drop("words").withColumn("crawl", F.explode(F.array(F.lit(1), F.lit(2))))
    before = F.col("context_before")
    after = F.when(F.col("crawl") == 2, F.concat("context_after", F.lit(" again"))).otherwise(
        F.col("context_after")
    )
    return sides.select(
        F.concat(F.lit("crawl-"), F.col("crawl").cast("string"), F.lit(".warc.gz")).alias("warc_path"),
        F.col("doc_id").alias("record_offset"),
        F.concat(
            F.lit("https://www.example.org/"),
            "lang",
            F.lit("/"),
            F.floor(F.col("doc_id") / 50).cast("string"),
        ).alias("page_url"),
        F.concat(
            F.lit("https://img.example.org/"),
            "source",
            F.lit("/"),
            (F.col("n_chars") % 7).cast("string"),
            F.lit(".jpg"),
        ).alias("image_url"),
        (F.col("n_chars") % 20).cast("int").alias("img_pos"),
        before.alias("context_before"),
        after.alias("context_after"),
        "alt_text",
    )


def _with_found(contexts: DataFrame) -> DataFrame:
    return contexts.withColumn(
        "found_alt_in_context",
        extraction.alt_in_context(F.col("alt_text"), F.col("context_before"), F.col("context_after")),
    )


def doc_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contexts of both crawls, and whether their alt text occurs in them."""
    return _with_found(_doc_contexts(spark, sf_dir))


def stored_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated document contexts, written as the context table.

    Alt texts are looked for in the rows that stay: which ones stay does not depend on it.
    """

    def build():
        kept = store.dedup_contexts(_doc_contexts(spark, sf_dir))
        return store.to_context_rows(_with_found(kept), "training")

    return written(spark, sf_dir, "contexts", build)


def span_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rated span for every stored context."""
    n = F.col("record_offset")
    start = ((n * 37) % 1000 + 1) / 1001.0
    end = ((n * 91) % 1000 + 1) / 1001.0
    return stored_contexts(spark, sf_dir).select(
        "context_id",
        F.array_join(F.slice(F.split("context_after", " "), 1, 6), " ").alias("predicted_text"),
        F.col("img_pos").alias("start_token"),
        (F.col("img_pos") + 5).alias("end_token"),
        start.alias("start_confidence"),
        end.alias("end_confidence"),
        ((start + end) / 2).alias("average_confidence"),
        F.sqrt(start * end).alias("span_confidence"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending predictions of two models, written as the prediction table."""

    def build():
        spans = span_rows(spark, sf_dir)
        first = store.to_prediction_rows(spans, "models/a")
        return first.unionByName(store.to_prediction_rows(spans, "models/b"))

    return written(spark, sf_dir, "predictions", build)


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched assets: one row for every image URL but those of one source, written once."""
    k = F.col("k")

    def build():
        urls = doc_contexts(spark, sf_dir).groupBy("image_url").agg(
            F.sum("record_offset").alias("k"), F.min("record_offset").alias("vec_key")
        )
        return urls.filter(~F.contains("image_url", F.lit("/src3/"))).select(
            "image_url",
            (k % 10 != 0).alias("http_ok"),
            F.when(k % 7 != 0, (k * 31) % 20000 + 3000).alias("declared_length"),
            (150 + (k * 53) % 500).cast("int").alias("width"),
            (150 + (k * 71) % 500).cast("int").alias("height"),
            (k % 13 != 0).alias("decodable"),
            "vec_key",
        )

    return written(spark, sf_dir, "assets", build)


def with_embeddings(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds an image embedding per asset and a text embedding per prediction.

    Both sides pick their vector by a number modulo the size of the embedding
    table, so every vector is used.
    """
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    size = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    image = vectors.select(
        F.col("vec_id").alias("image_vec"), F.col("embedding").alias("image_embedding")
    )
    words = vectors.select(
        F.col("vec_id").alias("text_vec"), F.col("embedding").alias("text_embedding")
    )
    keyed = rows.withColumn("image_vec", F.col("vec_key") % size).withColumn(
        "text_vec", (F.length("predicted_text") * 7 + F.coalesce("vec_key", F.lit(0))) % size
    )
    return keyed.join(image, "image_vec", "left").join(words, "text_vec", "left")


def scored_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admitted and scored predictions."""
    pending = store.pending_predictions(predictions(spark, sf_dir), stored_contexts(spark, sf_dir))
    admitted = enrichment.admit_assets(
        pending, assets(spark, sf_dir), hot_urls=_hot_images(spark, sf_dir)
    )
    return enrichment.score_admitted(with_embeddings(admitted, spark, sf_dir))


def _hot_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hot_keys(stored_contexts(spark, sf_dir), "image_url", 100)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current results of all predictions, written as the result table."""
    return written(
        spark,
        sf_dir,
        "results",
        lambda: enrichment.to_result_rows(scored_outcomes(spark, sf_dir), F.lit(1)),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as logits over 64 positions: a vector scores starts, its successor ends."""
    vectors = table(spark, sf_dir, "embeddings")
    size = vectors.agg(F.count(F.lit(1)).alias("n")).scalar()
    nxt = vectors.select(
        F.pmod(F.col("vec_id") - 1, size).alias("vec_id"), F.col("embedding").alias("end_logits")
    )
    return vectors.select("vec_id", F.col("embedding").alias("start_logits"), "label").join(
        nxt, "vec_id"
    ).withColumn("seq_len", (F.lit(20) + F.col("vec_id") % 45).cast("int"))


def labelled_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted spans beside labels that differ from them here and there."""
    best = prediction.best_positions(logits(spark, sf_dir))
    shift = (F.col("vec_id") % 3).cast("int")
    return best.withColumns(
        {"true_start_token": F.col("start_token"), "true_end_token": F.col("end_token") - shift}
    )


def corpus_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return written(
        spark, sf_dir, "vocabulary", lambda: vocabulary.build_vocabulary(docs, ["text"])
    )


def piece_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces made of the corpus vocabulary: usual words, their endings, and the letters of other words."""

    def build() -> DataFrame:
        words = corpus_vocabulary(spark, sf_dir)
        usual = words.filter("n >= 20")
        letters = words.filter("n >= 3").select(
            F.explode(F.regexp_extract_all("token", F.lit("(?s)."), F.lit(0))).alias("token")
        )
        endings = usual.filter("length(token) >= 5").select(F.concat(F.lit("##"), F.substring("token", -3, 3)))
        pieces = usual.select("token").union(endings).union(letters).union(letters.select(F.concat(F.lit("##"), "token")))
        numbered = vocabulary.number_tokens(pieces.distinct().withColumn("n", F.lit(1)))
        return numbered.select(F.col("token").alias("piece"), F.col("token_id").alias("piece_id"))

    return written(spark, sf_dir, "pieces", build)


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as contexts with one key each."""
    return doc_contexts(spark, sf_dir).filter("warc_path = 'crawl-1.warc.gz'").select(
        F.col("record_offset").alias("context_id"), "context_before", "context_after", "alt_text"
    )


def encoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document context, with its alt text."""

    def build():
        texts = doc_texts(spark, sf_dir)
        coded = vocabulary.encode_tokens(
            texts,
            "context_id",
            ["context_before", "context_after", "alt_text"],
            corpus_vocabulary(spark, sf_dir),
            keep=["alt_text"],
        )
        return coded.select(
            "context_id",
            "alt_text",
            F.col("context_before_tokens").alias("before_tokens"),
            F.col("context_after_tokens").alias("after_tokens"),
            F.col("context_before_ids").alias("before_ids"),
            F.col("context_after_ids").alias("after_ids"),
            F.col("alt_text_ids").alias("alt_ids"),
        )

    return written(spark, sf_dir, "encoded", build)


def write_archives(spark: SparkSession, sf_dir: str) -> str:
    """The crawl records as ``.warc.gz`` archives, written by the tasks; returns their folder."""
    import gzip
    import os

    folder = work_path(spark, "archives")

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext
        from pyarrow import fs

        part = TaskContext.get().partitionId()
        local = folder if "://" in folder else f"file://{os.path.abspath(folder)}"
        filesystem, root = fs.FileSystem.from_uri(local)
        filesystem.create_dir(root, recursive=True)
        name = f"part-{part:05d}.warc.gz"
        count = 0
        with filesystem.open_output_stream(f"{root}/{name}", compression=None) as out:
            for frame in batches:
                for row in frame.itertuples():
                    member = gzip.compress(_warc_record(row), 1)
                    # Half a member, whose rest is lost, and what is no member at all.
                    if row.record_offset % 19 == 8:
                        out.write(member[: len(member) // 2])
                    if row.record_offset % 19 == 9:
                        out.write(b"no member")
                    out.write(member)
                    count += 1
        yield pd.DataFrame({"name": [name], "records": [count]})

    records = crawl_records(spark, sf_dir)
    files = records.mapInPandas(write, "name string, records long")
    files.write.parquet(work_path(spark, "archive-names"))
    return folder


def _warc_record(row) -> bytes:
    head = b""
    if row.http_parsed:
        kind = f"Content-Type: {row.content_type}\r\n" if row.content_type else ""
        head = f"HTTP/1.1 200 OK\r\n{kind}\r\n".encode()
    payload = head + bytes(row.html_bytes)
    fields = (
        f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {row.page_url}\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    )
    return fields.encode() + payload + b"\r\n\r\n"


def png(width: int, height: int, shade: int) -> bytes:
    """A plain grey PNG image."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = (b"\0" + bytes([shade]) * width) * height
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(rows))
        + chunk(b"IEND", b"")
    )


def write_images(spark: SparkSession, sf_dir: str) -> str:
    """One image file per embedding, sized by its id; every ninth is damaged."""
    import os

    folder = work_path(spark, "images")

    def write(batches):
        from pyarrow import fs

        local = folder if "://" in folder else f"file://{os.path.abspath(folder)}"
        filesystem, root = fs.FileSystem.from_uri(local)
        filesystem.create_dir(root, recursive=True)
        for frame in batches:
            for vec_id in frame["vec_id"]:
                data = png(100 + vec_id % 300, 100 + vec_id % 200, int(vec_id % 256))
                if vec_id % 9 == 4:
                    data = data[:40]
                with filesystem.open_output_stream(f"{root}/{vec_id}.png", compression=None) as out:
                    out.write(data)
            yield frame

    vectors = table(spark, sf_dir, "embeddings").select("vec_id")
    vectors.mapInPandas(write, "vec_id long").write.parquet(work_path(spark, "image-names"))
    return folder
