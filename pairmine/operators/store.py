"""Keyed tables: first-write-wins contexts, append-only predictions, upserted results.

Keys are hashes of the natural keys, so they are stable across runs and need no
global numbering.  "Insertion order" is ``(warc_path, record_offset, img_pos)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmine import settings
from pairmine.session import stage

INSERTION_ORDER = ["warc_path", "record_offset", "img_pos"]


def surrogate_key(*natural_key: str) -> Column:
    """Hash of the natural key; a null part counts as ''."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in natural_key]
    return F.sha2(F.concat_ws(settings.KEY_SEPARATOR, *parts), 256)


def with_context_id(contexts: DataFrame) -> DataFrame:
    return contexts.withColumn("context_id", surrogate_key("image_url", "page_url"))


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    The rank limit is applied before the shuffle too (each task sends at most one
    row per key), so a key that holds a third of all rows costs no more than any
    other.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def dedup_contexts(contexts: DataFrame) -> DataFrame:
    """One row per ``(image_url, page_url)``: the first in insertion order wins."""
    return first_per_key(with_context_id(contexts), "context_id", INSERTION_ORDER)


def insert_new(
    batch: DataFrame, stored: DataFrame, key: str, batch_rows: int | None = None
) -> DataFrame:
    """Rows of a key-unique batch whose key is not stored yet.  Reads only the stored keys.

    With ``batch_rows`` known to be small, 64-bit hashes of the batch's keys are
    broadcast first, and only the stored keys that share one are shuffled: a
    small batch costs a scan of the key column, not a shuffle of it.
    """
    known = stored.select(key)
    if batch_rows is not None and batch_rows <= settings.BROADCAST_ROW_LIMIT:
        hashes = batch.select(F.xxhash64(key).alias("_hash"))
        known = known.join(
            F.broadcast(hashes), F.xxhash64(known[key]) == F.col("_hash"), "left_semi"
        )
    return batch.join(known, key, "left_anti")


def unprocessed(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``done``; made for wide rows.

    Only the key columns are compared.  When little is left to do, the open keys
    are broadcast (their number is counted) and the wide rows are not shuffled;
    when nothing is done yet, there is no join at all.
    """
    if done.isEmpty():
        return rows
    open_keys = stage(rows.select(key).join(done.select(key), key, "left_anti"), "open-keys")
    if open_keys.count() <= settings.BROADCAST_ROW_LIMIT:
        return rows.join(F.broadcast(open_keys), key, "left_semi")
    return rows.join(done.select(key), key, "left_anti")


def insert_contexts(
    contexts: DataFrame, stored: DataFrame, batch_rows: int | None = None
) -> DataFrame:
    """Insert-or-ignore: the new rows of a batch, deduplicated, against the stored table."""
    return insert_new(dedup_contexts(contexts), stored, "context_id", batch_rows)


def to_context_rows(kept: DataFrame, mode: str = "inference") -> DataFrame:
    """Kept contexts as table rows.

    ``training`` mode flags those whose alt text occurs in their context;
    ``inference`` mode flags none.
    """
    if mode not in ("training", "inference"):
        raise ValueError(f"unknown mode: {mode}")
    candidate = F.col("found_alt_in_context") if mode == "training" else F.lit(False)
    return kept.select(
        "context_id",
        "image_url",
        "page_url",
        "warc_path",
        "record_offset",
        "img_pos",
        "context_before",
        "context_after",
        "alt_text",
        candidate.alias("is_training_candidate"),
        F.lit(settings.STATUS_PROCESSED).alias("status_extraction"),
        F.current_timestamp().alias("extraction_timestamp"),
    )


def mark_training_candidates(contexts: DataFrame, ids: DataFrame) -> DataFrame:
    """Set the flag of every context whose id is listed in ``ids(context_id)``."""
    listed = ids.select("context_id").distinct().withColumn("_listed", F.lit(True))
    return (
        contexts.join(listed, "context_id", "left")
        .withColumn(
            "is_training_candidate",
            F.col("is_training_candidate") | F.coalesce(F.col("_listed"), F.lit(False)),
        )
        .select(*contexts.columns)
    )


#: A page that ends before this many rows is found by each task keeping its first rows.
DIRECT_ROWS = 10_000
#: Archive bytes (compressed) that one entry of the rank index stands for.
STRETCH_BYTES = 1 << 20


def _page(df: DataFrame, order: list[str], limit: int | None, offset: int) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the given order; all rows, unsorted, without a limit.

    A page is read by a caller who wants that page.  The stages themselves read
    whole tables and never page.
    """
    if limit is None:
        return df
    if offset + limit <= DIRECT_ROWS:
        return df.orderBy(*order).offset(offset).limit(limit)
    return ranked_page(df, order, limit, offset)


def _overlap(sizes: DataFrame, place: list[str], low: int, high: int) -> tuple | None:
    """First and last place whose rows are among ranks ``low`` to ``high``, and the rows before."""
    running = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = sizes.withColumn("_end", F.sum("_size").over(running))
    hit = counted.filter((F.col("_end") > low) & (F.col("_end") - F.col("_size") < high))
    at = F.struct(*place)
    found = hit.agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.min(F.col("_end") - F.col("_size")).alias("before")
    ).first()
    return (found["first"], found["last"], found["before"]) if found["before"] is not None else None


def _between(first, last, places: dict[str, Column]) -> Column:
    """Places from ``first`` to ``last``, nulls first; on the leading column as a plain
    comparison, too, which reaches the scan."""
    at = F.struct(*[c.alias(n) for n, c in places.items()])

    def edge(row):
        return F.struct(*[F.lit(row[n]).cast("string" if n == "warc_path" else "long").alias(n) for n in places])

    inside = (at >= edge(first)) & (at <= edge(last))
    path = places["warc_path"]
    if first["warc_path"] is not None:
        inside &= (path >= first["warc_path"]) & (path <= last["warc_path"])
    elif last["warc_path"] is None:
        inside &= path.isNull()
    return inside


def ranked_page(
    df: DataFrame, order: list[str], limit: int, offset: int, stretch: int = STRETCH_BYTES
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in the given order, without sorting those before.

    ``order`` starts with ``warc_path`` and ``record_offset``.  Rows are counted by archive,
    then, in the archives that the page meets, by stretches of so many archive bytes; running
    counts show in which stretches the page lies, and only their rows are read in full and
    sorted.  Counting reads the two columns and pre-aggregates; what one task ranks is a row
    for each archive, then for each stretch of the page's archives.  Nulls come first.  Both
    counts run when the page is asked for.
    """
    path, record = F.col(order[0]), F.col(order[1]).cast("long")
    high = offset + limit
    by_path = df.groupBy(path.alias("warc_path")).agg(F.count(F.lit(1)).alias("_size"))
    archives = _overlap(by_path, ["warc_path"], offset, high)
    if archives is None:
        return df.limit(0)
    first, last, before = archives
    near = df.filter(_between(first, last, {"warc_path": path}))
    places = {"warc_path": path, "stretch": F.floor(record / F.lit(stretch)).cast("long")}
    by_stretch = near.groupBy(*[c.alias(n) for n, c in places.items()]).agg(F.count(F.lit(1)).alias("_size"))
    first, last, inner = _overlap(by_stretch, list(places), offset - before, high - before)
    rows = near.filter(_between(first, last, places))
    return rows.orderBy(*order).offset(offset - before - inner).limit(limit)


def training_contexts(contexts: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    columns = ["context_id", "context_before", "context_after", "alt_text"]
    flagged = contexts.filter("is_training_candidate").select(*columns, *INSERTION_ORDER)
    return _page(flagged, INSERTION_ORDER + ["context_id"], limit, offset).select(*columns)


def inference_contexts(contexts: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    columns = [
        "context_id", "context_before", "context_after", "alt_text", "image_url", "page_url",
    ]
    rows = contexts.select(*columns, *INSERTION_ORDER)
    return _page(rows, INSERTION_ORDER + ["context_id"], limit, offset).select(*columns)


def to_prediction_rows(spans: DataFrame, model_path: str) -> DataFrame:
    """Decoded spans as pending prediction rows of one model."""
    return (
        spans.withColumn("model_path", F.lit(model_path))
        .withColumn("prediction_id", surrogate_key("context_id", "model_path"))
        .select(
            "prediction_id",
            "context_id",
            "model_path",
            "predicted_text",
            "start_token",
            "end_token",
            "start_confidence",
            "end_confidence",
            "average_confidence",
            "span_confidence",
            F.lit(settings.STATUS_PENDING).alias("status_enrichment"),
            F.current_timestamp().alias("prediction_timestamp"),
        )
    )


def append_predictions(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Predictions of the batch that are not stored yet: a re-run adds nothing."""
    return insert_new(batch, stored, "prediction_id")


def pending_predictions(
    predictions: DataFrame, contexts: DataFrame, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Pending predictions with the image they describe."""
    pending = predictions.filter(F.col("status_enrichment") == settings.STATUS_PENDING).select(
        "prediction_id", "context_id", "predicted_text"
    )
    images = contexts.select("context_id", "image_url", *INSERTION_ORDER)
    queue = pending.join(images, "context_id")
    columns = ["prediction_id", "predicted_text", "image_url"]
    return _page(queue, INSERTION_ORDER + ["prediction_id"], limit, offset).select(*columns)


def latest_per_key(df: DataFrame, key: str, version: str) -> DataFrame:
    """The row with the highest version of each key.  As skew-proof as ``first_per_key``."""
    window = Window.partitionBy(key).orderBy(F.col(version).desc())
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def upsert_results(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """One result per prediction; the last write replaces every field.

    ``version`` orders the writes.  The result table itself is append-only: this
    is both the reader's view of it and the compaction step.
    """
    merged = stored.unionByName(batch)
    return latest_per_key(merged, "prediction_id", "version")


def result_status(error_message: Column, split_download_status: bool = False) -> Column:
    """Status that a result gives its prediction."""
    failed = F.lit(settings.STATUS_FAILED)
    if split_download_status:
        failed = F.when(
            error_message.startswith("Download"), F.lit(settings.STATUS_FAILED_DOWNLOAD)
        ).otherwise(failed)
    return F.when(error_message.isNull(), F.lit(settings.STATUS_SCORED)).otherwise(failed)


def apply_status(
    predictions: DataFrame, results: DataFrame, split_download_status: bool = False
) -> DataFrame:
    """Predictions with the status their current result gives them.

    ``results`` holds one row per prediction.
    """
    outcome = results.select(
        "prediction_id",
        result_status(F.col("error_message"), split_download_status).alias("_status"),
    )
    return (
        predictions.join(outcome, "prediction_id", "left")
        .withColumn("status_enrichment", F.coalesce("_status", "status_enrichment"))
        .select(*predictions.columns)
    )


def final_results(
    predictions: DataFrame,
    contexts: DataFrame,
    results: DataFrame,
    min_score: float | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Successful pairs, best score first.

    The result filter runs before the joins, and the joins carry no page text.
    With a limit, every task keeps only its own best rows; without one, the
    order comes from a distributed range sort.
    """
    good = results.filter(F.col("error_message").isNull())
    if min_score is not None:
        good = good.filter(F.col("clip_score") >= min_score)
    scored = good.select("prediction_id", "image_local_path", "clip_score")
    ranked = (
        predictions.join(scored, "prediction_id")
        .join(contexts.select("context_id", "image_url", "page_url"), "context_id")
        .select(
            "prediction_id",
            "image_url",
            "page_url",
            "image_local_path",
            "predicted_text",
            "start_confidence",
            "end_confidence",
            "average_confidence",
            "span_confidence",
            "clip_score",
        )
        .orderBy(F.col("clip_score").desc_nulls_last(), "prediction_id")
    )
    return ranked if limit is None else ranked.limit(limit)
