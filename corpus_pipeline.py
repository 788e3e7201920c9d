"""From raw documents to packed sequences, one operator per stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pairmine.llm import decontaminate, linedup, packing, quality, simhash
from pairmine.llm.common import ship_code, table
from pairmine.llm.queries import vocabulary_path
from pairmine.session import stage


#: Documents go to the Python workers and back in batches of about this size, not by the
#: 10,000, so what a task holds outside the heap does not grow with the length of documents.
BATCH_BYTES = "2m"


def _in_small_batches(function: Callable) -> Callable:
    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return function(spark, docs, sf_dir)

    return run


@_in_small_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the labels of ``docs``."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


@_in_small_batches
def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line resembles."""
    return linedup.drop_repeated_lines(docs)


@_in_small_batches
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs)


@_in_small_batches
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage occurs."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


@_in_small_batches
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens."""
    return packing.pack(docs, vocabulary_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A trained classifier, fingerprints and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again before the next."""
    ship_code(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, f"stage-{number}")
    return docs
