"""Incremental runs: the batch plans applied to what is new.

State lives in the tables.  Every micro-batch writes its own named batch and
reads the tables without it, so a repeated micro-batch gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pairmine import schemas
from pairmine.operators import store
from pairmine.plans import enrich, extract
from pairmine.session import scratch, stage
from pairmine.sources import keys, tables


def _start(stream: DataFrame, root: str, name: str, write: Callable) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root.rstrip('/')}/_checkpoints/{name}")
        .trigger(availableNow=True)
        .start()
    )


def stream_contexts(
    found: DataFrame, root: str, name: str = "contexts", mode: str = "inference"
) -> StreamingQuery:
    """Add the new contexts of a stream of extracted contexts to the context table.

    ``found`` is ``extract_contexts`` (or ``contexts_of_records``) applied to a
    stream.  Seen keys are looked up in the buckets of the stored keys, not kept
    in a growing state store.
    """
    spark = found.sparkSession
    tables.create_tables(spark, root)

    def write(batch: DataFrame, epoch: int) -> None:
        label = f"{name}-{epoch:09d}"
        with scratch(batch.sparkSession, "stream-contexts") as folder:
            new = extract.new_contexts(batch, root, label, folder)
            keys.add_context_batch(store.to_context_rows(new, mode), root, label)
        tables.compact(batch.sparkSession, root, "image_context")

    return _start(found, root, name, write)


def stream_enrichment(
    spark: SparkSession,
    root: str,
    assets: DataFrame,
    add_embeddings: Callable[[DataFrame], DataFrame],
    name: str = "enrichment",
    max_files: int = 1_000,
    **limits,
) -> StreamingQuery:
    """Write a result for every newly stored, pending prediction.

    Statuses follow from the results (``enrich.current_predictions``), so the
    prediction table is never rewritten.
    """
    predictions = (
        spark.readStream.schema(schemas.PREDICTION)
        .option("maxFilesPerTrigger", max_files)
        .parquet(f"{root.rstrip('/')}/predicted_descriptions/batch=*")
    )

    def write(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        label = f"{name}-{epoch:09d}"
        finished = tables.read_table(session, root, "clip_results", without_batch=label)
        new = store.insert_new(batch, finished, "prediction_id", batch.count())
        # Staged, a small batch is known to be small, and the contexts it joins
        # are not shuffled.
        with scratch(session, "stream-predictions") as folder:
            open_rows = stage(new, "open-predictions", folder)
            pending = enrich.pending_pairs(
                open_rows, tables.read_table(session, root, "image_context")
            )
            rows = enrich.outcomes(
                pending, assets, add_embeddings, F.unix_micros(F.current_timestamp()), **limits
            )
            tables.write_batch(rows, root, "clip_results", label)
        tables.compact(session, root, "clip_results")

    return _start(predictions, root, name, write)
