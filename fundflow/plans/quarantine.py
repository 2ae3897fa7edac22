"""Silver with what it rejects: both in one pass, from one parse.

A table has two folders, written by one job. ``outcome=kept`` holds silver rows;
``outcome=rejected`` the messages that broke a rule, with the rule, where they came
from and their raw text, to be mended and sent again. Each row counts the
messages it stands for, so the report can be taken from the files: kept, rejected
and repeated messages add up to those read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.operators.payload import flatten, parse_payload
from fundflow.operators.quality import judge_each, rule_counts
from fundflow.schemas import Feed
from fundflow.sources.lake import DAY, with_audit

KEPT, REJECTED = "/outcome=kept", "/outcome=rejected"
_EXTRA = T.StructType(
    [
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("rule", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("json_payload", T.StringType()),
    ]
)


def outcomes(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Silver columns of the first message of each key and of each incomplete message.

    With ``rule``, ``messages`` and, where a rule is broken, the raw text.
    """
    parsed = parse_payload(bronze, feed.payload)
    typed = flatten(parsed, feed, "json_payload")
    return judge_each(typed, feed)


def split_silver(bronze: DataFrame, feed: Feed, path: str) -> dict[str, int]:
    """Write kept and rejected rows, and return the quality counts, in one pass."""
    counts = Observation(f"{feed.name}_outcomes")
    outcome = F.when(F.col("rule") == "kept", "kept").otherwise("rejected")
    judged = outcomes(bronze, feed).withColumn("outcome", outcome)
    placed = judged.hint("rebalance", "outcome", DAY).observe(counts, *rule_counts(feed))
    (
        with_audit(placed)
        .write.partitionBy("outcome", DAY)
        .option("partitionOverwriteMode", "static")
        .parquet(path, mode="overwrite")
    )
    return {rule: counts.get[rule] for rule in feed.rules}


def _schema(feed: Feed) -> T.StructType:
    partitions = [f for f in feed.silver if f.name == DAY]
    fields = [f for f in feed.silver if f.name != DAY]
    outcome = T.StructField("outcome", T.StringType())
    return T.StructType([*fields, *_EXTRA.fields, outcome, *partitions])


def read_outcomes(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """All rows of a split table."""
    return spark.read.schema(_schema(feed)).parquet(path)


def read_rejected(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Messages that broke a rule: rule, origin and raw text."""
    origin = ["kafka_topic", "kafka_partition", "kafka_offset", DAY]
    rows = read_outcomes(spark, path, feed).filter("outcome = 'rejected'")
    return rows.select("rule", *origin, "messages", "json_payload")


def stored_quality(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """``(feed, rule, rows)`` counted from the files of a split table."""
    rows = read_outcomes(spark, path, feed).select("rule", "messages")
    return (
        rows.agg(*rule_counts(feed))
        .select(F.lit(feed.name).alias("feed"), *feed.rules)
        .unpivot(["feed"], feed.rules, "rule", "rows")
    )
