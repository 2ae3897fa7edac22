"""Bronze rows to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.schemas import NAV, TXN, Feed

# One bad message lowers a count, it never fails a job: a field that does not
# match its type becomes NULL. The tokens NaN and Infinity are no prices.
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}


def parse_payload(
    bronze: DataFrame, schema: T.StructType, filtered: bool = False
) -> DataFrame:
    """Add the struct column ``parsed``, read from the message text.

    Set ``filtered`` if the fields are filtered next. Spark pushes such a filter
    below the parse and then reads each message once per condition; it does not
    push it below a generator, so the message is read once.
    """
    parsed = F.from_json("json_payload", schema, _JSON_OPTIONS)
    return bronze.withColumn("parsed", F.explode(F.array(parsed)) if filtered else parsed)


def flatten(parsed: DataFrame, feed: Feed, *extra: str) -> DataFrame:
    """The silver columns of a feed, plus ``kafka_partition`` for the row order.

    A time that cannot be read becomes NULL. ``extra`` columns are carried.
    """
    origin = {
        "event_timestamp": F.try_to_timestamp("parsed.timestamp"),
        "ingestion_date": F.col("ingestion_date"),
        "kafka_topic": F.col("topic"),
        "kafka_offset": F.col("offset"),
    }
    columns = [
        origin[name] if name in origin else F.col(f"parsed.{name}")
        for name in feed.silver_columns
    ]
    return parsed.select(
        *[column.alias(name) for column, name in zip(columns, feed.silver_columns)],
        F.col("partition").alias("kafka_partition"),
        *extra,
    )


def flatten_nav(parsed: DataFrame) -> DataFrame:
    return flatten(parsed, NAV)


def flatten_txn(parsed: DataFrame) -> DataFrame:
    return flatten(parsed, TXN)
