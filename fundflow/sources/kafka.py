"""Message topics as streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    topic: str,
    servers: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` only matters before the first checkpoint.

    ``extra`` takes further connector options; on busy topics set
    ``minPartitions`` (more tasks than topic partitions) and
    ``maxOffsetsPerTrigger`` (bounded batches after a pause).
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **(extra or {}),
    }


def kafka_stream(
    spark: SparkSession,
    topic: str,
    servers: str,
    starting: str = "earliest",
    fail_on_data_loss: bool = False,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """One topic as an unbounded frame. Needs the Kafka connector on the classpath."""
    options = kafka_options(topic, servers, starting, fail_on_data_loss, extra)
    return spark.readStream.format("kafka").options(**options).load()
