"""Bronze to silver: parse, judge, keep, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from fundflow.functions import required
from fundflow.operators.payload import flatten, parse_payload
from fundflow.operators.quality import MESSAGE_ORDER, judge, quality_report, rule_counts
from fundflow.schemas import NAV, TXN, Feed
from fundflow.sources.lake import by_day, write_partitioned


def typed_rows(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Messages with typed columns, before any rule."""
    return flatten(parse_payload(bronze, feed.payload), feed)


def complete_rows(bronze: DataFrame, feed: Feed) -> DataFrame:
    """Typed rows with every required field."""
    parsed = parse_payload(bronze, feed.payload, filtered=True)
    return flatten(parsed, feed).filter(required(feed.required))


def judged_rows(bronze: DataFrame, feed: Feed) -> DataFrame:
    return judge(typed_rows(bronze, feed), feed)


def _kept(judged: DataFrame, feed: Feed) -> DataFrame:
    return judged.filter("rule = 'kept'").select(*feed.silver_columns)


def silver_nav(bronze: DataFrame) -> DataFrame:
    """Clean price ticks, distinct on fund and time."""
    return _kept(judged_rows(bronze, NAV), NAV)


def silver_txn(bronze: DataFrame) -> DataFrame:
    """Clean transactions, distinct on their id.

    A transaction without a type is always dropped, as is one with a type
    outside the allowed set; whether a row stays never depends on other rows'
    types. ``status`` is carried and not judged.
    """
    return _kept(judged_rows(bronze, TXN), TXN)


def _quality(bronze: DataFrame, feed: Feed) -> DataFrame:
    # Only what decides a rule is parsed and shuffled.
    typed = typed_rows(bronze, feed).select(*feed.judged_columns, *MESSAGE_ORDER)
    return quality_report(judge(typed, feed), feed)


def nav_quality(bronze: DataFrame) -> DataFrame:
    """Price messages by the first rule they fail: ``(feed, rule, rows)``."""
    return _quality(bronze, NAV)


def txn_quality(bronze: DataFrame) -> DataFrame:
    """Transaction messages by the first rule they fail: ``(feed, rule, rows)``."""
    return _quality(bronze, TXN)


def build_silver(bronze: DataFrame, feed: Feed, path: str) -> dict[str, int]:
    """Write a silver table and return its quality counts, in one pass.

    The counts ride on the write. They are taken in the last stage, where Spark
    counts each finished task once, so a lost executor does not inflate them;
    judged rows are few more than kept ones, so carrying them there is cheap.
    """
    counts = Observation(f"{feed.name}_quality")
    placed = by_day(judged_rows(bronze, feed)).observe(counts, *rule_counts(feed))
    write_partitioned(_kept(placed, feed), path)
    return {rule: counts.get[rule] for rule in feed.rules}
