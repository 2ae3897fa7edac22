"""The two feeds, derived from the given tables by fixed rules.

Every row of a table becomes a message. Some are spoiled or sent twice, chosen
by the row number, so that each validation rule has something to find; the SQL
counterparts state the same rules without JSON.

For ``m = event_id % 50``: 7 is not JSON, 13 has an unreadable time, 19 is sent
again later with a value one higher, 11 has no value, 17 a negative one. In
transactions, 3 has no id, 5 has its fund code as text, 23 has no type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.operators.envelope import to_envelope
from fundflow.schemas import NAV_TOPIC, TXN_TOPIC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream. The pattern matches a file and a folder alike."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _slot() -> Column:
    return F.col("event_id") % 50


def _records(events: DataFrame, topic: str, payload: Column) -> DataFrame:
    """Broker records; a repeated message follows its original."""
    sent = F.when(_slot() == 19, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = events.withColumn("copy", F.explode(sent))
    text = F.when(_slot() == 7, "not json").otherwise(payload)
    return copies.select(
        F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("event_id") * 2 + F.col("copy")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def _seconds() -> Column:
    text = F.substring(F.col("ts").cast("string"), 1, 19)
    return F.when(_slot() == 13, "garbage").otherwise(text)


def _value() -> Column:
    value = (F.col("value") + F.col("copy")).cast("decimal(18,2)")
    return F.when(_slot() == 17, -value).when(_slot() != 11, value)


def nav_records(events: DataFrame, renamed: bool = False) -> DataFrame:
    """Price messages; with ``renamed``, funds change their name within a day."""
    name = F.concat(F.lit("Fund "), F.col("user_id").cast("string"))
    if renamed:
        name = F.concat(name, F.lit("-"), (F.col("event_id") % 3).cast("string"))
    payload = F.struct(
        _seconds().alias("timestamp"),
        F.col("user_id").alias("scheme_code"),
        name.alias("scheme_name"),
        _value().alias("nav"),
    )
    return _records(events, NAV_TOPIC, F.to_json(payload))


def txn_records(events: DataFrame) -> DataFrame:
    """Transaction messages."""
    event = F.col("event_type")
    kind = (
        F.when(_slot() == 23, None)
        .when(event.isin("purchase", "view"), "BUY")
        .when(event == "signup", "SELL")
        .when(event == "click", "REDEEM")
        .otherwise("SWITCH")
    )
    number = F.col("event_id").cast("string")

    def payload(fund: Column) -> Column:
        fields = F.struct(
            F.when(_slot() != 3, F.concat(F.lit("TXN_"), number)).alias("transaction_id"),
            _seconds().alias("timestamp"),
            fund.alias("scheme_code"),
            kind.alias("transaction_type"),
            _value().alias("amount"),
            F.when(F.col("event_id") % 10 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        )
        return F.to_json(fields)

    fund = F.col("user_id")
    text = F.when(_slot() == 5, payload(fund.cast("string"))).otherwise(payload(fund))
    return _records(events, TXN_TOPIC, text)


def nav_bronze(spark: SparkSession, sf_dir: str, renamed: bool = False) -> DataFrame:
    return to_envelope(nav_records(table(spark, sf_dir, "events"), renamed))


def txn_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_envelope(txn_records(table(spark, sf_dir, "events")))


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as typed transactions: the larger input for the aggregates."""
    flag = F.col("l_returnflag")
    kind = F.when(flag == "A", "BUY").when(flag == "N", "SELL").otherwise("REDEEM")
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.col("l_suppkey").cast("int").alias("scheme_code"),
        kind.alias("transaction_type"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_shipdate").cast("timestamp").alias("event_timestamp"),
        F.to_date("l_shipdate").alias("ingestion_date"),
        *LINE_ORDER,
    )


# What tells two order lines with one id apart.
LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
