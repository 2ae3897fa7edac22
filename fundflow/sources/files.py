"""Names and small texts in any store that Spark reaches."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def context(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Hadoop's ``FileContext`` for a path, and the path itself."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    at = hadoop.Path(path)
    uri = at.toUri()
    if uri.getScheme() is None:
        return hadoop.FileContext.getFileContext(conf), at
    return hadoop.FileContext.getFileContext(uri, conf), at


def names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Entries of a folder with their times in milliseconds; none if there is no such folder."""
    files, at = context(spark, folder)
    if not files.util().exists(at):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in files.util().listStatus(at)]


def text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return spark.read.text(path, wholetext=True).first()[0]


def listing_digest(spark: SparkSession, *folders: str) -> str:
    """What tells one set of Parquet files from another: names, sizes and times, not contents.

    Files are listed by Spark and reduced to one row; contents are not read.
    """
    present = [f for f in folders if names(spark, f)]
    if not present:
        return "none"
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(present)
        .selectExpr("xxhash64(path, length, modificationTime) AS file", "length")
    )
    row = found.selectExpr("count(*) AS n", "sum(length) AS size", "bit_xor(file) AS files").first()
    return f"{row['n']}-{row['size']}-{row['files']}"
