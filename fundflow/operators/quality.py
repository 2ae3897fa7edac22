"""Which rule each message meets, and the report counted from that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions import domain, positive, required
from fundflow.operators.dedup import first_per_key
from fundflow.schemas import Feed

MESSAGE_ORDER = ("kafka_partition", "kafka_offset")


def judge(typed: DataFrame, feed: Feed) -> DataFrame:
    """Rows that survive deduplication, each with ``rule`` and ``messages``.

    ``rule`` is the first rule the row fails, or ``kept``; ``messages`` is the
    number of messages the row stands for. All messages with a required field
    missing share one row. The order of the steps is part of the result: a key
    whose first row is not positive loses its later rows as well.

    Both the silver table and its quality report come from this one frame, so
    counting costs no pass of its own.
    """
    complete = required(feed.required)
    # Key columns are required, so a missing key marks the incomplete messages.
    keyed = typed.withColumns({name: F.when(complete, F.col(name)) for name in feed.key})
    distinct = first_per_key(keyed, feed.key, MESSAGE_ORDER, tally="messages")
    verdict = F.when(F.col(feed.key[0]).isNull(), "required").when(
        ~positive(feed.measure), "not_positive"
    )
    if feed.domain_column:
        verdict = verdict.when(~domain(feed.domain_column, feed.domain), "bad_domain")
    return distinct.withColumn("rule", verdict.otherwise("kept"))


def judge_each(typed: DataFrame, feed: Feed, payload: str = "json_payload") -> DataFrame:
    """Like ``judge``, with every rejected message as a row of its own.

    Messages with a required field missing are not put together, so nothing gathers
    under a missing key. ``payload`` is the raw text, kept where a rule is broken.
    A row's rule depends on that row alone, so it is known before the shuffle, and
    no text of a good message takes part in it.
    """
    complete = required(feed.required)
    good = complete & positive(feed.measure)
    if feed.domain_column:
        good = good & domain(feed.domain_column, feed.domain)
    lone = {f"_{name}": F.when(~complete, F.col(name)) for name in MESSAGE_ORDER}
    marked = typed.withColumn(payload, F.when(~good, F.col(payload))).withColumns(lone)
    judged = first_per_key(marked, [*feed.key, *lone], MESSAGE_ORDER, tally="messages").drop(*lone)
    verdict = F.when(~complete, "required").when(~positive(feed.measure), "not_positive")
    if feed.domain_column:
        verdict = verdict.when(~domain(feed.domain_column, feed.domain), "bad_domain")
    return judged.withColumn("rule", verdict.otherwise("kept"))


def rule_counts(feed: Feed) -> list[Column]:
    """Aggregates over a judged frame, one per rule of the feed, in order."""
    failed = F.col("rule") == "required"
    messages = F.col("messages")
    columns = {
        "read": F.sum(messages),
        "required": F.sum(F.when(failed, messages)),
        "duplicate": F.sum(F.when(~failed, messages - 1)),
    }
    for rule in feed.rules:
        count = columns.get(rule, F.count_if(F.col("rule") == rule))
        columns[rule] = F.coalesce(count, F.lit(0)).cast("bigint").alias(rule)
    return [columns[rule] for rule in feed.rules]


def quality_report(judged: DataFrame, feed: Feed) -> DataFrame:
    """``(feed, rule, rows)``; a rule that no row meets appears with 0.

    Every message is counted once: ``read`` is the sum of the other rules.
    """
    return (
        judged.agg(*rule_counts(feed))
        .select(F.lit(feed.name).alias("feed"), *feed.rules)
        .unpivot(["feed"], feed.rules, "rule", "rows")
    )


def enough_rows(total: int, min_rows: int) -> int:
    """``total``, if it is at least ``min_rows``."""
    if total < min_rows:
        raise ValueError(f"ranking table has {total} rows, expected {min_rows}")
    return total


def verify_gold(ranking: DataFrame, min_rows: int = 0) -> DataFrame:
    """``(total_funds)`` of a loaded ranking table; fails below ``min_rows``."""
    total = F.count("*")
    if min_rows > 0:
        too_few = F.format_string("ranking table has %d rows, expected %d", total, F.lit(min_rows))
        total = F.when(total >= min_rows, total).otherwise(F.raise_error(too_few).cast("bigint"))
    return ranking.agg(total.alias("total_funds"))
