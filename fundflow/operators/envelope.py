"""Broker records to bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_envelope(records: DataFrame) -> DataFrame:
    """Keep the raw message as text, with its origin and its day.

    The day is that of the broker's record time, not of the time inside the
    payload. Works on streams and on batches.
    """
    origin = ["topic", "partition", "offset", "timestamp"]
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("json_payload"),
        *origin,
        F.to_date("timestamp").alias("ingestion_date"),
    )
