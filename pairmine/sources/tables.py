"""The stored tables: Parquet folders that grow by named batches.

A batch is one sub-folder ``batch=<name>``.  Writing a batch again replaces
exactly that batch, so a repeated micro-batch or a repeated job leaves no
duplicates, whatever was lost in between.  ``compact`` merges small batches
(``sources.segments``); a merged batch can be read and replaced like any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmine.schemas import TABLES
from pairmine.sources.segments import FAN_IN, Batches

_EMPTY_BATCH = "created"
#: Tables whose new folders a stream follows; merging would take folders away unread.
FOLLOWED = ("predicted_descriptions",)


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the tables that are missing; existing ones stay as they are."""
    for name, schema in TABLES.items():
        if not _exists(spark, _path(root, name)):
            empty = spark.createDataFrame([], schema)
            empty.write.parquet(f"{_path(root, name)}/batch={_EMPTY_BATCH}")


def read_table(
    spark: SparkSession, root: str, name: str, without_batch: str | None = None
) -> DataFrame:
    """A table in its fixed row type, optionally without one batch.

    A batch that is being written again must not see its own earlier rows.
    """
    stored = batches(spark, root, name).read()
    if without_batch is not None:
        stored = stored.filter(F.col("batch") != without_batch)
    return stored.drop("batch")


def batches(spark: SparkSession, root: str, name: str) -> Batches:
    """Where the batches of a table lie."""
    return Batches(spark, _path(root, name), TABLES[name])


def compact(spark: SparkSession, root: str, name: str, fan_in: int = FAN_IN) -> None:
    """Merge the small batches of a table when ``fan_in`` of them have piled up."""
    if name in FOLLOWED:
        raise ValueError(f"a stream follows the batches of {name}")
    batches(spark, root, name).compact({_EMPTY_BATCH}, fan_in)


def write_batch(df: DataFrame, root: str, name: str, batch: str) -> None:
    """Write ``df`` as one batch of a table, in the table's column order and types.

    The rows are written beside the table's batches, under a name that readers pass over, and
    take the place of an earlier batch of that name when they are whole: a run that fails
    leaves the earlier batch as it was.
    """
    spark = df.sparkSession
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name].fields])
    folder = _path(root, name)
    fresh, old = (f"{folder}/_{kind}-{uuid.uuid4().hex}" for kind in ("incoming", "replaced"))
    path = spark._jvm.org.apache.hadoop.fs.Path
    filesystem = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        typed.write.parquet(fresh)
        target = path(f"{folder}/batch={batch}")
        if filesystem.exists(target):
            _rename(filesystem, target, path(old))
        _rename(filesystem, path(fresh), target)
    finally:
        filesystem.delete(path(fresh), True)
        filesystem.delete(path(old), True)


def _rename(filesystem, source, target) -> None:
    if not filesystem.rename(source, target):
        raise OSError(f"cannot move {source.toString()} to {target.toString()}")
