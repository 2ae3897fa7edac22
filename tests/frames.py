"""Small literal frames."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from fundflow.operators.envelope import to_envelope
from fundflow.schemas import KAFKA_SCHEMA, NAV_TOPIC, TXN_TOPIC

SENT = datetime(2024, 3, 1, 12, 0)


def message(value, topic, partition=0, offset=0, sent=SENT):
    if isinstance(value, dict):
        value = json.dumps(value)
    body = None if value is None else bytearray(value.encode())
    return (None, body, topic, partition, offset, sent)


def bronze(spark: SparkSession, messages: list[tuple]) -> DataFrame:
    return to_envelope(spark.createDataFrame(messages, KAFKA_SCHEMA))


def price(nav=10.0, at="2024-03-01 10:00:00", fund=1, name="One", **where):
    body = {"timestamp": at, "scheme_code": fund, "scheme_name": name, "nav": nav}
    return message(body, NAV_TOPIC, **where)


def transaction(id="T1", kind="BUY", amount=5.0, fund=1, at="2024-03-01 10:00:00", **where):
    body = {
        "transaction_id": id,
        "timestamp": at,
        "scheme_code": fund,
        "transaction_type": kind,
        "amount": amount,
        "status": "SUCCESS",
    }
    return message(body, TXN_TOPIC, **where)


def ticks(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(fund, name, nav, time)`` as silver prices; the day is that of the time."""
    schema = "scheme_code int, scheme_name string, nav double, event_timestamp string"
    frame = spark.createDataFrame(rows, schema)
    return frame.selectExpr(
        "scheme_code",
        "scheme_name",
        "nav",
        "cast(event_timestamp as timestamp) as event_timestamp",
        "to_date(event_timestamp) as ingestion_date",
    )


def rows(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan_text(frame: DataFrame) -> str:
    """The physical plan before it runs."""
    return frame._jdf.queryExecution().executedPlan().toString()
