"""Date-partitioned Parquet tables of the bronze and silver layers."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.schemas import BRONZE_SCHEMA, NAV, TXN

DAY = "ingestion_date"


def with_audit(frame: DataFrame) -> DataFrame:
    """Add the time of processing; used just before a sink and nowhere else."""
    return frame.withColumn("processed_at", F.current_timestamp())


def s3a_conf(endpoint: str, access: str, secret: str, ssl: bool = False) -> dict[str, str]:
    """Session settings for an S3-compatible object store, for the caller to apply."""
    # Public Hadoop S3A setting names and classes.
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider": (
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider"
        ),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def _scan(
    spark: SparkSession, path: str, schema: T.StructType, since: date | None, until: date | None
) -> DataFrame:
    table = spark.read.schema(schema).parquet(path)
    if since is not None:
        table = table.filter(F.col(DAY) >= F.lit(since))
    if until is not None:
        table = table.filter(F.col(DAY) <= F.lit(until))
    return table.select(*schema.names)


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """A bronze table, read at its root so that the stream's file log is honoured.

    Several roots, one per period, are read one by one, each by its own log, and put
    together. The schema is given, not inferred: an empty table gives an empty frame. A
    missing path raises. ``since`` and ``until`` prune whole days.
    """
    roots = [path] if isinstance(path, str) else list(path)
    parts = [_scan(spark, root, BRONZE_SCHEMA, since, until) for root in roots]
    return reduce(DataFrame.union, parts)


def silver_path(root: str, folder: str) -> str:
    return f"{root.rstrip('/')}/{folder}"


def read_silver(
    spark: SparkSession,
    root: str,
    since: date | None = None,
    until: date | None = None,
    part: str = "",
) -> tuple[DataFrame, DataFrame]:
    """The silver tables of both feeds, prices first; ``part`` is a folder within each."""
    nav, txn = (
        _scan(spark, silver_path(root, feed.folder) + part, feed.silver, since, until)
        for feed in (NAV, TXN)
    )
    return nav, txn


def by_day(frame: DataFrame) -> DataFrame:
    """Bring the rows of a day together before a partitioned write.

    Without this every task writes a file into every day it holds rows of. The
    rebalance hint lets adaptive execution size the output: small days are
    merged into one task, a day above the advisory size is split over several.
    """
    return frame.hint("rebalance", DAY)


def write_silver(df: DataFrame, path: str) -> None:
    """Replace a silver table, always as a whole: rows are distinct over all days.

    ``df`` must not be read from ``path``: Spark deletes the old files first, so
    rows on a lost executor could not be read again.
    """
    write_partitioned(by_day(df), path)


def write_partitioned(df: DataFrame, path: str) -> None:
    """Overwrite a table partitioned by day, with rows already placed."""
    (
        with_audit(df)
        .write.partitionBy(DAY)
        .option("partitionOverwriteMode", "static")
        .parquet(path, mode="overwrite")
    )
