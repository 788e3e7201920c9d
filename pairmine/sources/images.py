"""Fetched image files as a table of assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_images(spark: SparkSession, path: str) -> DataFrame:
    """``(local_path, declared_length, width, height, decodable)`` of the files at ``path``.

    An undecodable file stays, with ``decodable`` false.  The file size comes
    from the scan's own metadata, so there is neither a second scan nor a join.
    """
    images = spark.read.format("image").option("dropInvalid", False).load(path)
    return images.select(
        F.col("image.origin").alias("local_path"),
        F.col("_metadata.file_size").alias("declared_length"),
        F.when(F.col("image.width") > 0, F.col("image.width")).alias("width"),
        F.when(F.col("image.height") > 0, F.col("image.height")).alias("height"),
        F.coalesce(F.col("image.width") > 0, F.lit(False)).alias("decodable"),
    )


def to_assets(fetched: DataFrame, scanned: DataFrame) -> DataFrame:
    """Asset table: fetch log ``(image_url, http_ok, local_name)`` with the scanned files.

    ``local_name`` is the file's base name; it carries the hash of its URL, so
    it is unique.
    """
    files = scanned.withColumn("local_name", F.regexp_extract("local_path", "([^/]*)$", 1))
    return fetched.join(files, "local_name", "left").select(
        "image_url",
        "http_ok",
        "declared_length",
        "width",
        "height",
        F.coalesce("decodable", F.lit(False)).alias("decodable"),
    )
