"""Session-level helpers: the shared working folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}
_shipped: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can see.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset
    and the session is a local one does a folder of this machine serve.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="pairmine-")
    return _local_dirs[application]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh folder below the shared one that goes when the block ends, on failure too."""
    path = work_path(spark, name)
    try:
        yield path
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or below ``folder``, and read it back.

    For an expensive result that several later steps read: it is computed once,
    survives lost executors, and later steps read only the columns they need.
    """
    path = f"{folder}/{name}" if folder else work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input that is too small to fill them.

    A scan with at least one partition per core, which any large one has, stays
    as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def ship(spark: SparkSession, folder: str) -> None:
    """Give the Python workers the package in ``folder``, once per application.

    The same as naming it in ``--py-files`` when the application starts.
    """
    folder = os.path.abspath(folder)
    key = (spark.sparkContext.applicationId, folder)
    if key in _shipped:
        return
    base, name = os.path.split(folder)
    archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for root, _, files in os.walk(folder):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(root, file)
                    out.write(path, os.path.relpath(path, base))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(key)
