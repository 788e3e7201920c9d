"""The stored keys of a table, laid out in buckets of their hash.

An anti-join of a batch with them shuffles the batch alone: the stored side is read bucket by
bucket as it lies.  A small batch names its keys, and only the buckets of these are
opened.  Every append adds at most one file to a bucket; when a bucket has ``MAX_FILES`` on
average, all are rewritten beside the old ones.  So the files that a batch opens are bounded by
the layout, however many batches came before.

The folder is ``<table>_keys/buckets=<n>/v=<version>``; the highest version whose job
committed counts.  Keys carry their batch.  Those of batches that the table does not hold
(a run that died in between) do not count, and batches that the keys lack are read from the
table, so the keys never decide more than the table does.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine.sources import tables

BUCKETS = 64
MAX_FILES = 8
#: A batch of up to this many keys names them.
NAMED_KEYS = 500


class KeyTable:
    """The keys of one table of a store."""

    def __init__(self, spark: SparkSession, root: str, table: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.table, self.key, self.buckets = spark, root, table, key, buckets
        self.folder = f"{root.rstrip('/')}/{table}_keys/buckets={buckets}"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []

    def version(self) -> int | None:
        """The highest version that was written whole."""
        found = [int(n[2:]) for n in self._children(self.folder) if n.startswith("v=")]
        whole = [v for v in found if self._files.exists(self._path(f"{self.folder}/v={v}/_SUCCESS"))]
        return max(whole, default=None)

    def _table(self, version: int) -> str:
        """The session's name for a version; the files are the table's, the name goes with the session."""
        at = f"{self.folder}/v={version}"
        name = "keys_" + hashlib.sha1(at.encode()).hexdigest()[:20]
        self.spark.sql(f"drop table if exists {name}")
        self.spark.sql(
            f"create table {name} ({self.key} string, batch string) using parquet "
            f"clustered by ({self.key}) into {self.buckets} buckets location '{at}'"
        )
        return name

    def stored(self) -> DataFrame | None:
        """``(key, batch)`` in buckets; None before the first append."""
        version = self.version()
        return None if version is None else self.spark.table(self._table(version))

    def _write(self, keys: DataFrame, version: int) -> None:
        """One file for each bucket that gets keys."""
        rows = keys.select(F.col(self.key).cast("string"), F.col("batch").cast("string"))
        rows.repartition(self.buckets, self.key).write.insertInto(self._table(version))

    def file_count(self) -> int:
        return sum(n.startswith("part-") for n in self._children(f"{self.folder}/v={self.version()}"))

    def append(self, keys: DataFrame, batch: str) -> None:
        """Add the keys of a batch that has been written to the table; compacts when files pile up."""
        self._write(keys.select(self.key, F.lit(batch).alias("batch")), self.version() or 0)
        if self.file_count() > self.buckets * MAX_FILES:
            self.compact()

    def compact(self) -> None:
        """Rewrite all keys, one file a bucket, as the next version, and remove what is older."""
        old = self.version()
        if old is None:
            return
        held = set(self._table_batches())
        fresh = old + 1
        self._files.delete(self._path(f"{self.folder}/v={fresh}"), True)  # of a run that died
        self._write(self.stored().filter(F.col("batch").isin(*held)).distinct(), fresh)
        for name in self._children(self.folder):
            if name.startswith("v=") and int(name[2:]) < fresh:
                self._files.delete(self._path(f"{self.folder}/{name}"), True)

    def _table_batches(self) -> list[str]:
        return tables.batches(self.spark, self.root, self.table).names()

    def repair(self) -> None:
        """Add the keys of batches that the table holds and the keys lack."""
        stored = self.stored()
        known = {r["batch"] for r in stored.select("batch").distinct().collect()} if stored is not None else set()
        for batch in self._table_batches():
            if batch not in known:
                rows = tables.batches(self.spark, self.root, self.table).read_batch(batch)
                if not rows.isEmpty():
                    self._write(rows.select(self.key, F.lit(batch).alias("batch")), self.version() or 0)

    def missing(self, rows: DataFrame, batch: str, count: int | None = None) -> DataFrame:
        """The rows (unique by key) whose key no other batch of the table holds.

        ``count`` is the number of rows, if known: a few name their keys.
        """
        stored = self.stored()
        if stored is None:
            return rows
        others = [b for b in self._table_batches() if b != batch]
        known = stored.filter(F.col("batch").isin(*others)) if others else stored.limit(0)
        if count is not None and count <= NAMED_KEYS:
            wanted = [r[self.key] for r in rows.select(self.key).collect()]  # at most NAMED_KEYS
            if not wanted:
                return rows
            known = known.filter(F.col(self.key).isin(*wanted))
        return rows.join(known.select(self.key).hint("merge"), self.key, "left_anti")


def context_keys(spark: SparkSession, root: str) -> KeyTable:
    return KeyTable(spark, root, "image_context", "context_id")


def add_context_batch(rows: DataFrame, root: str, batch: str) -> None:
    """Write a batch of contexts, then its keys."""
    spark = rows.sparkSession
    tables.write_batch(rows, root, "image_context", batch)
    written = spark.read.schema("context_id string").parquet(f"{root.rstrip('/')}/image_context/batch={batch}")
    context_keys(spark, root).append(written, batch)
