"""Archives to the context table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairmine.operators import contexts, pages, store
from pairmine.session import scratch, stage
from pairmine.sources import keys, tables, warc


def contexts_of_records(records: DataFrame, **limits) -> DataFrame:
    """Admitted, decoded and extracted crawl records; one narrow stage."""
    admitted = pages.admit_pages(records).drop("http_parsed", "content_length")
    decoded = pages.decode_pages(admitted).drop("content_type")
    return contexts.extract_contexts(decoded, **limits)


def new_contexts(found: DataFrame, root: str, batch: str, folder: str | None = None) -> DataFrame:
    """Deduplicated contexts that no other batch of the table holds.

    The deduplicated contexts are staged (below ``folder``, which the caller removes), so pages are
    parsed once whatever happens later, and their number decides how the stored keys are looked up.
    Those lie in buckets, so the table is neither read nor shuffled (``sources.keys``).
    """
    staged = stage(store.dedup_contexts(found), "contexts", folder)
    known = keys.context_keys(found.sparkSession, root)
    known.repair()
    return known.missing(staged, batch, staged.count())


def extract_archives(
    spark: SparkSession,
    archives: str,
    root: str,
    batch: str,
    mode: str = "inference",
    recursive: bool = False,
    **limits,
) -> dict[str, int]:
    """Run extraction over a file or folder of archives and add the new contexts.

    One pass over the archives has two outcomes: contexts, and records that cannot yield any.
    Both are written side by side, partitioned by outcome; the latter go to the table
    ``quarantine`` with their reason.  Returns the counters of the run, observed on the way.
    Nothing staged is left behind.
    """
    tables.create_tables(spark, root)
    seen, added, held_back = Observation("records"), Observation("contexts"), Observation("quarantine")
    records = warc.read_warc(spark, archives, recursive)
    records = records.observe(
        seen,
        F.count_if(~pages.is_damaged(records)).alias("records"),
        F.count_if(pages.is_damaged(records)).alias("damaged"),
        F.count_if(pages.is_admitted()).alias("html_responses"),
        F.count_if(pages.is_admitted() & (F.col("content_length") > 0)).alias("parsed_pages"),
    )
    with scratch(spark, "extract") as folder:
        outcomes = stage_outcomes(records, f"{folder}/outcomes", **limits)
        refused = outcomes.filter("outcome = 'quarantine'").observe(
            held_back, F.count(F.lit(1)).alias("quarantined")
        )
        tables.write_batch(refused, root, "quarantine", batch)
        found = outcomes.filter("outcome = 'context'").drop("outcome", "reason")
        rows = store.to_context_rows(new_contexts(found, root, batch, folder), mode).observe(
            added,
            F.count(F.lit(1)).alias("contexts_added"),
            F.count_if("is_training_candidate").alias("contexts_marked"),
        )
        keys.add_context_batch(rows, root, batch)
    return {**seen.get, **held_back.get, **added.get}


def stage_outcomes(records: DataFrame, path: str, **limits) -> DataFrame:
    """Contexts and refused records, from one pass, written partitioned by ``outcome``."""
    judged = pages.judge_records(records)
    admitted = judged.withColumn("html", F.when(F.col("reason").isNull(), F.col("html")))
    tagged = contexts.extract_contexts(admitted, tag="reason", **limits)
    outcome = F.when(F.col("reason").isNull(), "context").otherwise("quarantine")
    tagged.withColumn("outcome", outcome).write.partitionBy("outcome").parquet(path)
    schema = tagged.schema.add("outcome", "string")
    return records.sparkSession.read.schema(schema).parquet(path)
