"""Compaction of stored tables: many small batches become a few segments.

A segment is a folder ``<table>_merged/s=<number>-<level>`` with the rows of many batches, each
row with the name of its batch, and the list of these batches beside them.  It appears whole,
by one renaming, and only then its sources go.  A batch that several places hold counts
where it was written last: in its own folder, else in the segment of the highest number.  So a
run that dies between the two steps leaves nothing double, and a batch that is
written again after its merging replaces its merged rows.

Segments are merged with those of their level only, so a row is rewritten once a level, and
``FAN_IN`` small batches and ``FAN_IN`` segments of a level are the most that stay.  As in
``tables.write_batch``, a table has one writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: So many small batches, or segments of a level, become one segment.
FAN_IN = 16
#: Batches of this size stay as they are; files of segments are about as large.
LARGE_BYTES = 128 << 20


@dataclass(frozen=True)
class Segment:
    number: int
    level: int
    path: str
    batches: frozenset[str]


class Batches:
    """The folders and segments that hold the batches of one table."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType):
        self.spark, self.folder, self.merged = spark, folder, f"{folder}_merged"
        self.schema = T.StructType(schema.fields + [T.StructField("batch", T.StringType())])
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _children(self, folder: str, prefix: str) -> list[str]:
        at = self._path(folder)
        names = [s.getPath().getName() for s in self._files.listStatus(at)] if self._files.exists(at) else []
        return sorted(n[len(prefix) :] for n in names if n.startswith(prefix))

    def folders(self) -> list[str]:
        """Batches that have a folder of their own."""
        return self._children(self.folder, "batch=")

    def segments(self) -> list[Segment]:
        """The segments, newest first."""
        labels = self._children(self.merged, "s=")
        if not labels:
            return []
        listed = self.spark.read.schema("number long, batch string").parquet(
            *[f"{self.merged}/s={label}/batches" for label in labels]
        )
        held: dict[int, set[str]] = {}
        for number, batch in listed.collect():  # names of batches
            held.setdefault(number, set()).add(batch)
        found = []
        for label in labels:
            number, level = map(int, label.split("-"))
            found.append(Segment(number, level, f"{self.merged}/s={label}", frozenset(held.get(number, ()))))
        return sorted(found, key=lambda s: -s.number)

    def names(self) -> list[str]:
        return sorted(set(self.folders()).union(*[s.batches for s in self.segments()]))

    def _holders(self) -> list[tuple[Segment, set[str]]]:
        """Each segment, newest first, with the batches that count there."""
        newer, out = set(self.folders()), []
        for segment in self.segments():
            out.append((segment, set(segment.batches - newer)))
            newer |= segment.batches
        return out

    def _of_folders(self, names: list[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema).option("basePath", self.folder)
        return reader.parquet(*[f"{self.folder}/batch={n}" for n in names])

    def _of_segment(self, segment: Segment, counting: set[str]) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(f"{segment.path}/rows")
        dead = sorted(segment.batches - counting)
        return rows.filter(~F.col("batch").isin(*dead)) if dead else rows

    def read(self) -> DataFrame:
        """All rows with their batch; filters on ``batch`` reach the folders and the segments' files."""
        rows = self.spark.read.schema(self.schema).parquet(self.folder)
        for segment, counting in self._holders():
            if counting:
                rows = rows.unionByName(self._of_segment(segment, counting))
        return rows

    def read_batch(self, name: str) -> DataFrame:
        """The rows of one batch, from the place where it counts."""
        if name in self.folders():
            return self._of_folders([name])
        for segment, counting in self._holders():
            if name in counting:
                return self._of_segment(segment, counting).filter(F.col("batch") == name)
        raise ValueError(f"no batch {name} in {self.folder}")

    def _bytes(self, path: str) -> int:
        return self._files.getContentSummary(self._path(path)).getLength()

    def _merge(self, level: int, names: list[str], sources: list[tuple[Segment, set[str]]], number: int) -> None:
        parts = [self._of_folders(names)] if names else []
        parts += [self._of_segment(segment, counting) for segment, counting in sources if counting]
        batches = set(names).union(*[counting for _, counting in sources])
        gone = [f"{self.folder}/batch={n}" for n in names] + [segment.path for segment, _ in sources]
        if parts:
            rows = parts[0]
            for part in parts[1:]:
                rows = rows.unionByName(part)
            files = 1 + sum(self._bytes(path) for path in gone) // LARGE_BYTES
            fresh = f"{self.merged}/_incoming-{uuid.uuid4().hex}"
            try:
                # Sorted within a file, so the footers tell which files a batch is in.
                spread = rows.repartition(files).sortWithinPartitions("batch")
                spread.write.parquet(f"{fresh}/rows")
                listed = self.spark.createDataFrame([(number, b) for b in sorted(batches)], "number long, batch string")
                listed.coalesce(1).write.parquet(f"{fresh}/batches")
                target = self._path(f"{self.merged}/s={number}-{level}")
                if not self._files.rename(self._path(fresh), target):
                    raise OSError(f"cannot move {fresh} to {target.toString()}")
            finally:
                self._files.delete(self._path(fresh), True)
        for path in gone:
            self._files.delete(self._path(path), True)

    def compact(self, keep: set[str], fan_in: int = FAN_IN) -> None:
        """Merge small batches, then levels, while ``fan_in`` of a kind are there.

        Batches of ``keep`` keep their folder, as the one that marks an empty table.
        """
        names = [n for n in self.folders() if n not in keep]
        if len(names) < fan_in and len(self._children(self.merged, "s=")) < fan_in:
            return
        number = 1 + max((s.number for s in self.segments()), default=0)
        small = [n for n in names if self._bytes(f"{self.folder}/batch={n}") < LARGE_BYTES]
        if len(small) >= fan_in:
            self._merge(0, small, [], number)
        level = 0
        while True:
            held = self._holders()
            if not any(s.level >= level for s, _ in held):
                return
            same = [(s, counting) for s, counting in held if s.level == level]
            if len(same) >= fan_in:
                number = 1 + max(s.number for s, _ in held)
                self._merge(level + 1, [], same, number)
            level += 1
