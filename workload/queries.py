"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.functions import markup, spans, text, urls
from pairmine.operators import (
    contexts,
    encoding,
    enrichment,
    metrics,
    pages,
    prediction,
    report,
    split,
    store,
    subwords,
    training,
    vocabulary,
)
from pairmine.operators.barrier import drop_nulls
from pairmine.session import stage, work_path
from pairmine.sources import images, tables, warc
from pairmine.streaming import incremental
from workload import adapters as ad

CONTEXT_COLUMNS = [
    "warc_path", "record_offset", "img_pos", "page_url", "image_url", "alt_text",
    "context_before", "context_after", "found_alt_in_context",
]


def _joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), " ").alias(column)


# --- scans, sources, sinks -------------------------------------------------


def warc_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The given pages, written as archives with damage between them and scanned back in small ranges."""
    records = warc.read_warc(spark, ad.write_archives(spark, sf), split_bytes=100_000)
    return records.select(
        "damage",
        "page_url",
        "http_parsed",
        "content_type",
        "content_length",
        F.md5("html_bytes").alias("payload_md5"),
    )


def page_admission(spark, sf):
    return pages.admit_pages(ad.crawl_records(spark, sf), read_payload=False).select(
        "record_offset", "page_url", "content_type", "content_length"
    )


def table_roundtrip(spark, sf):
    root = work_path(spark, "store")
    tables.create_tables(spark, root)
    tables.create_tables(spark, root)
    tables.write_batch(ad.stored_contexts(spark, sf), root, "image_context", "first")
    return tables.read_table(spark, root, "image_context").drop("extraction_timestamp")


def asset_scan(spark, sf):
    scanned = images.scan_images(spark, ad.write_images(spark, sf))
    return scanned.select(
        F.regexp_extract("local_path", "([0-9]+)[.]png$", 1).cast("bigint").alias("vec_id"),
        "width",
        "height",
        "decodable",
    )


def ingest_counters(spark, sf):
    records = ad.crawl_records(spark, sf)
    extracted = stage(
        contexts.extract_contexts(pages.decode_pages(pages.admit_pages(records))), "extracted"
    )
    kept = store.to_context_rows(store.dedup_contexts(extracted), "training")
    return pages.ingest_counters(records, extracted, kept)


# --- page to context extraction --------------------------------------------


def page_body(spark, sf):
    bodies = pages.page_bodies(ad.image_pages(spark, sf))
    return bodies.select(
        "page_url", F.length("body").alias("body_chars"), F.md5("body").alias("body_md5")
    )


def page_text(spark, sf):
    # With no image kept, every image stays in the text as its alt text.
    texts = contexts.page_texts(contexts.anchored_pages(ad.image_pages(spark, sf), max_images=0))
    return drop_nulls(texts.select("page_url", "page_text"), "page_text")


def page_images(spark, sf):
    anchored = contexts.anchored_pages(ad.image_pages(spark, sf))
    rows = anchored.select("page_url", F.explode_outer("anchors").alias("a")).filter("a.kept")
    return rows.select("page_url", "a.pos", "a.src", "a.alt")


def resolve_url(spark, sf):
    refs = ad.table(spark, sf, "pages").select(
        F.col("url").alias("page_url"),
        F.explode(F.array(*[F.lit(r) for r in ad.REFERENCES])).alias("src"),
    )
    return refs.withColumn("image_url", urls.resolve_url("page_url", "src"))


def anchor_segments(spark, sf):
    texts = contexts.page_texts(contexts.anchored_pages(ad.image_pages(spark, sf)))
    parts = texts.select(
        "page_url",
        F.posexplode_outer(F.split("page_text", markup.ANCHOR_START)).alias("segment", "part"),
    ).filter("part is not null")
    return parts.select(
        "page_url",
        "segment",
        F.btrim(F.substring_index("part", markup.ANCHOR_STOP, -1)).alias("segment_text"),
    )


def image_contexts(spark, sf):
    """Flagship: all image contexts of the crawl."""
    return contexts.extract_contexts(ad.image_pages(spark, sf)).select(*CONTEXT_COLUMNS)


def context_word_filter(spark, sf):
    anchored = contexts.anchored_pages(ad.image_pages(spark, sf))
    windows = contexts.image_windows(contexts.page_texts(anchored))
    both = F.concat("context_before", F.lit(" "), "context_after")
    return windows.select("page_url", "img_pos", text.word_count(both).alias("words")).filter(
        F.col("words") >= settings.MIN_CONTEXT_WORDS
    )


def normalize_text(spark, sf):
    docs = ad.table(spark, sf, "documents")
    return docs.select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))


def alt_in_context(spark, sf):
    return ad.doc_contexts(spark, sf).select(
        "warc_path", "record_offset", "alt_text", "found_alt_in_context"
    )


def bad_page_quarantine(spark, sf):
    return pages.quarantine(ad.crawl_records(spark, sf))


# --- keyed store -----------------------------------------------------------


def context_dedup(spark, sf):
    found = contexts.extract_contexts(ad.both_crawls(spark, sf))
    return store.dedup_contexts(found).select(*CONTEXT_COLUMNS)


def context_insert_ignore(spark, sf):
    stored = store.dedup_contexts(contexts.extract_contexts(ad.image_pages(spark, sf, 1)))
    batch = contexts.extract_contexts(ad.image_pages(spark, sf, 2))
    return store.insert_contexts(batch, stored).select(*CONTEXT_COLUMNS)


def context_key(spark, sf):
    rows = store.with_context_id(ad.doc_contexts(spark, sf))
    return rows.select("warc_path", "record_offset", "image_url", "page_url", "context_id")


def training_candidates(spark, sf):
    flagged = ad.stored_contexts(spark, sf).filter("is_training_candidate")
    return flagged.select("context_id", "record_offset", "alt_text", "status_extraction")


def training_contexts_page(spark, sf):
    return store.training_contexts(ad.stored_contexts(spark, sf), limit=100, offset=50)


def inference_contexts_page(spark, sf):
    return store.inference_contexts(ad.stored_contexts(spark, sf), limit=100, offset=50)


def contexts_far_page(spark, sf):
    """A page behind many rows, found by counts; record numbers are small here, and so are the stretches."""
    columns = ["context_id", "context_before", "context_after", "alt_text", "image_url", "page_url"]
    order = [*store.INSERTION_ORDER, "context_id"]
    return store.ranked_page(ad.stored_contexts(spark, sf), order, 200, 120, stretch=16).select(*columns)


def prediction_append(spark, sf):
    stored = store.to_prediction_rows(
        ad.span_rows(spark, sf).filter("start_confidence > 0.5"), "models/a"
    )
    batch = ad.predictions(spark, sf)
    return store.append_predictions(batch, stored).select(
        "prediction_id", "context_id", "model_path", "predicted_text", "status_enrichment"
    )


def pending_queue(spark, sf):
    every = ad.predictions(spark, sf)
    status = F.when(F.col("start_confidence") < 0.3, settings.STATUS_SCORED).otherwise(
        F.col("status_enrichment")
    )
    return store.pending_predictions(
        every.withColumn("status_enrichment", status), ad.stored_contexts(spark, sf)
    )


def _two_writes(spark, sf):
    first = ad.results(spark, sf)
    failed = first.filter("clip_score < 0").withColumns(
        {
            "image_local_path": F.lit(None).cast("string"),
            "clip_score": F.lit(None).cast("double"),
            "error_message": F.lit("Download failed"),
            "version": F.lit(2).cast("bigint"),
        }
    )
    return first, failed


def clip_upsert(spark, sf):
    first, failed = _two_writes(spark, sf)
    return store.upsert_results(first, failed).select(
        "prediction_id",
        "image_local_path",
        F.round("clip_score", 6).alias("clip_score"),
        "clip_model_name",
        "error_message",
    )


def status_transition(spark, sf):
    first, failed = _two_writes(spark, sf)
    merged = store.upsert_results(first, failed)
    return store.apply_status(ad.predictions(spark, sf), merged).select(
        "prediction_id", "status_enrichment"
    )


def _ranked(spark, sf, **options):
    return store.final_results(
        ad.predictions(spark, sf), ad.stored_contexts(spark, sf), ad.results(spark, sf), **options
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def final_results(spark, sf):
    return _rounded(_ranked(spark, sf, min_score=0.0), *report.MEASURES)


def final_results_topk(spark, sf):
    # Rounded scores decide, so that both engines see the same ties.
    scores = ad.results(spark, sf).withColumn("clip_score", F.round("clip_score", 6))
    top = store.final_results(
        ad.predictions(spark, sf), ad.stored_contexts(spark, sf), scores, limit=100
    )
    return _rounded(top, *report.MEASURES)


# --- sequences -------------------------------------------------------------


def build_vocab(spark, sf):
    return vocabulary.build_vocabulary(ad.table(spark, sf, "documents"), ["text"])


def encode_tokens(spark, sf):
    ids = vocabulary.encode_tokens(
        ad.table(spark, sf, "documents"), "doc_id", ["text"], ad.corpus_vocabulary(spark, sf)
    )
    return ids.select("doc_id", _joined("text_ids"))


def encode_subwords(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id", "text")
    coded = subwords.encode_pieces(docs, ["text"], ad.piece_vocabulary(spark, sf))
    return coded.select("doc_id", _joined("text_ids"), _joined("text_words"))


def _training(spark, sf):
    return encoding.encode_training(ad.encoded_texts(spark, sf), ad.MAX_LEN)


def encode_training(spark, sf):
    return _training(spark, sf).select("context_id", "seq_len", _joined("sequence"))


def span_labels(spark, sf):
    kept = _training(spark, sf).filter("reject_reason is null")
    return kept.select("context_id", "true_start_token", "true_end_token")


def training_rejects(spark, sf):
    rejected = _training(spark, sf).filter("reject_reason is not null")
    return rejected.select("context_id", "reject_reason")


def reject_counts(spark, sf):
    return encoding.reject_counts(_training(spark, sf))


def pad_and_mask(spark, sf):
    padded = encoding.training_examples(ad.encoded_texts(spark, sf), ad.MAX_LEN)
    return padded.select("context_id", _joined("input_ids"), _joined("attention_mask"))


def encode_inference(spark, sf):
    encoded = encoding.encode_inference(ad.encoded_texts(spark, sf), ad.MAX_LEN, settings.MAX_BEFORE_TOKENS)
    return encoded.select("context_id", "seq_len", _joined("sequence"))


def max_examples(spark, sf):
    candidates = store.training_contexts(ad.stored_contexts(spark, sf))
    return split.limit_examples(candidates, ["context_id"], 200).select("context_id", "alt_text")


def train_val_split(spark, sf):
    docs = ad.table(spark, sf, "documents").select("doc_id", "lang")
    return split.train_validation_split(docs, "doc_id", 0.2, seed=7)


# --- span model ------------------------------------------------------------


def _examples(spark, sf):
    padded = encoding.training_examples(ad.encoded_texts(spark, sf), ad.MAX_LEN)
    needed = ["context_id", "sequence", "input_ids", "attention_mask", "true_start_token", "true_end_token"]
    return split.train_validation_split(padded.select(*needed), "context_id", 0.2)


def train_span_model(spark, sf):
    """Facts that any right training has: the loss of no weights, one that falls, a row per epoch, a whole reload."""
    parts = ad.written(spark, sf, "examples", lambda: _examples(spark, sf))
    train, validation = (parts.filter(F.col("part") == name) for name in ("train", "validation"))
    model, history = training.train_span_model(spark, train, validation, ad.MAX_LEN, [0.0, 0.001], max_epochs=4)
    path = work_path(spark, "model")
    model.save(path)
    training.write_history(history, f"{path}/history")
    stored = spark.read.schema(history.schema).json(f"{path}/history")
    best = training.select_best_run(history, "val_loss").first()
    again = training.evaluate(training.PointerModel.load(path), validation, ad.MAX_LEN)["loss"]
    losses = F.transform(F.array_sort(F.collect_list(F.when(F.col("metric") == "loss", F.struct("epoch", "value")))), lambda x: x["value"])
    return stored.groupBy("run_id").agg(
        F.count_if(F.col("metric") == "loss").alias("epochs"),
        F.count_if(F.col("metric") == "val_loss").alias("validated"),
        F.count_if(F.col("metric").isin("val_iou", "val_exact_match") & F.col("value").between(0, 1)).alias("shares"),
        F.round(F.max(F.when((F.col("metric") == "loss") & (F.col("epoch") == 0), F.col("value"))), 6).alias("first_loss"),
        (losses == F.reverse(F.array_sort(losses))).alias("falls"),
        F.lit(abs(again - best["value"]) < 1e-9).alias("reloaded"),
    )


def select_best_run(spark, sf):
    """Best epoch of every run: a run per embedding label, its vectors as epochs."""
    history = ad.table(spark, sf, "embeddings").select(
        F.concat(F.lit("run-"), F.col("label").cast("string")).alias("run_id"),
        F.col("vec_id").cast("int").alias("epoch"),
        F.lit("val_loss").alias("metric"),
        F.get("embedding", F.lit(0)).cast("double").alias("value"),
    )
    best = training.best_epochs(history, "val_loss", patience=10)
    winner = training.select_best_run(history, "val_loss", patience=10)
    return best.withColumn("selected", F.col("run_id") == winner.select("run_id").scalar())


def _arithmetic_scorer():
    """A model stand-in: logits are arithmetic on the token ids, so SQL can follow."""

    def predict(input_ids, attention_mask):
        import numpy as np

        ids = np.asarray(input_ids, dtype=np.int64)
        return {
            "start_logits": ((ids * 7919) % 1009 / 128.0).astype(np.float32),
            "end_logits": ((ids * 104729) % 1013 / 128.0).astype(np.float32),
        }

    return predict


def batch_predict(spark, sf):
    inputs = encoding.inference_inputs(ad.encoded_texts(spark, sf), ad.MAX_LEN, settings.MAX_BEFORE_TOKENS)
    scored = prediction.predict_logits(inputs, _arithmetic_scorer, ad.MAX_LEN)
    found = prediction.decode_predictions(scored).select(
        "context_id", "predicted_text", "start_token", "end_token", "span_confidence"
    )
    return _rounded(found, "span_confidence")


def span_argmax(spark, sf):
    return prediction.best_positions(ad.logits(spark, sf)).select(
        "vec_id", "start_token", "end_token"
    )


def span_softmax(spark, sf):
    probabilities = ad.logits(spark, sf).select(
        "vec_id", F.posexplode(spans.softmax(F.col("start_logits"))).alias("pos", "p")
    )
    return probabilities.select("vec_id", "pos", F.round("p", 9).alias("probability"))


def valid_spans(spark, sf):
    best = prediction.best_positions(ad.logits(spark, sf))
    return prediction.valid_spans(best).select("vec_id", "start_token", "end_token", "seq_len")


def decode_spans(spark, sf):
    encoded = encoding.encode_inference(ad.encoded_texts(spark, sf), ad.MAX_LEN, settings.MAX_BEFORE_TOKENS)
    spans_ = encoded.withColumns(
        {
            "start_token": (F.col("context_id") % 60).cast("int"),
            "end_token": (F.col("context_id") % 60 + F.col("context_id") % 8).cast("int"),
        }
    )
    named = prediction.token_strings(
        prediction.valid_spans(spans_).drop("sequence_tokens"),
        "context_id",
        ad.corpus_vocabulary(spark, sf),
    )
    return prediction.decode_spans(named).select("context_id", "predicted_text")


def span_confidence(spark, sf):
    best = prediction.valid_spans(prediction.best_positions(ad.logits(spark, sf)))
    rated = prediction.with_confidences(best)
    product = spans.span_confidence(F.col("start_confidence"), F.col("end_confidence"), "product")
    return _rounded(
        rated.withColumn("product_confidence", product).select(
            "vec_id", *report.CONFIDENCES, "product_confidence"
        ),
        *report.CONFIDENCES,
        "product_confidence",
    )


def exact_match(spark, sf):
    return _rounded(metrics.exact_match(ad.labelled_spans(spark, sf)), "exact_match")


def span_iou(spark, sf):
    return _rounded(metrics.mean_iou(ad.labelled_spans(spark, sf)), "iou")


def inference_counters(spark, sf):
    best = prediction.best_positions(ad.logits(spark, sf))
    return prediction.inference_counters(best, prediction.valid_spans(best))


# --- enrichment ------------------------------------------------------------


def url_admission(spark, sf):
    refs = resolve_url(spark, sf).select("image_url").distinct()
    return refs.withColumn("fetchable", urls.is_fetchable(F.col("image_url")))


def asset_name(spark, sf):
    found = resolve_url(spark, sf).select("image_url").distinct()
    return found.withColumn("asset", urls.asset_name("image_url"))


def asset_admission(spark, sf):
    pending = store.pending_predictions(ad.predictions(spark, sf), ad.stored_contexts(spark, sf))
    admitted = enrichment.admit_assets(pending, ad.assets(spark, sf))
    return admitted.select("prediction_id", "image_url", "reject_reason", "image_local_path")


def pair_similarity(spark, sf):
    pairs = ad.logits(spark, sf)
    score = enrichment.pair_similarity(
        F.when(F.col("label") != 0, F.lit("a text")), F.col("start_logits"), F.col("end_logits")
    )
    return pairs.select("vec_id", F.round(score, 6).alias("clip_score"))


def enrich_outcomes(spark, sf):
    return ad.scored_outcomes(spark, sf).select(
        "prediction_id",
        "image_local_path",
        F.round("clip_score", 6).alias("clip_score"),
        "error_message",
    )


def enrich_counters(spark, sf):
    return enrichment.enrichment_counters(ad.results(spark, sf))


# --- analysis --------------------------------------------------------------


def _pairs(spark, sf):
    """The ranked pairs as the report reads them: written once."""
    return ad.written(spark, sf, "pairs", lambda: _ranked(spark, sf))


def result_preview(spark, sf):
    return report.preview(_rounded(_pairs(spark, sf), "clip_score"))


def score_summary(spark, sf):
    numbers = ["mean", "stddev", "min", "max", "q1", "median", "q3"]
    return _rounded(report.summary(_pairs(spark, sf)), *numbers)


def score_correlation(spark, sf):
    return _rounded(report.correlation(_pairs(spark, sf)), "pearson")


def score_histogram(spark, sf):
    return report.histogram(_pairs(spark, sf))


def score_boxplot(spark, sf):
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return _rounded(report.boxplot(_pairs(spark, sf)), *numbers)


def score_heatmap(spark, sf):
    return report.heatmap(_pairs(spark, sf))


# --- incremental -----------------------------------------------------------


def stream_contexts(spark, sf):
    """Both crawls, streamed one after the other into one table, and the first one twice."""
    root = work_path(spark, "stream-store")
    source = ad.table(spark, sf, "pages")
    for name, crawl in (("first", 1), ("again", 1), ("second", 2)):
        stream = spark.readStream.schema(source.schema).parquet(f"{sf.rstrip('/')}/pages.parquet*")
        found = contexts.extract_contexts(ad.shape_pages(stream, crawl))
        incremental.stream_contexts(found, root, name).awaitTermination()
    stored = tables.read_table(spark, root, "image_context")
    return stored.select(*CONTEXT_COLUMNS[:-1])


def stream_enrichment(spark, sf):
    root = work_path(spark, "enrich-store")
    tables.create_tables(spark, root)
    tables.write_batch(ad.stored_contexts(spark, sf), root, "image_context", "all")
    tables.write_batch(ad.predictions(spark, sf), root, "predicted_descriptions", "all")
    query = incremental.stream_enrichment(
        spark, root, ad.assets(spark, sf), lambda rows: ad.with_embeddings(rows, spark, sf)
    )
    query.awaitTermination()
    return tables.read_table(spark, root, "clip_results").select(
        "prediction_id",
        "image_local_path",
        F.round("clip_score", 6).alias("clip_score"),
        "error_message",
    )


QUERIES = {
    f.__name__: f
    for f in [
        warc_scan, page_admission, table_roundtrip, asset_scan, ingest_counters,
        page_body, page_text, page_images, resolve_url, anchor_segments, image_contexts,
        context_word_filter, normalize_text, alt_in_context, bad_page_quarantine,
        context_dedup, context_insert_ignore, context_key, training_candidates,
        training_contexts_page, inference_contexts_page, contexts_far_page, prediction_append, pending_queue,
        clip_upsert, status_transition, final_results, final_results_topk,
        build_vocab, encode_tokens, encode_subwords, encode_training, span_labels, training_rejects,
        reject_counts, pad_and_mask, encode_inference, max_examples, train_val_split,
        train_span_model, select_best_run, batch_predict, span_argmax, span_softmax,
        valid_spans, decode_spans, span_confidence, exact_match, span_iou, inference_counters,
        url_admission, asset_name, asset_admission, pair_similarity, enrich_outcomes,
        enrich_counters, result_preview, score_summary, score_correlation, score_histogram,
        score_boxplot, score_heatmap, stream_contexts, stream_enrichment,
    ]
}
