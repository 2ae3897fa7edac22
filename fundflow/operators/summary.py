"""Silver summaries and display helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundflow.functions import exact_sum, settle
from fundflow.operators.positions import positions

# The order in which each table is shown, and how many rows of it.
_DISPLAY_ORDER = {
    "gold_aum_by_fund": [("ingestion_date", F.asc), ("scheme_code", F.asc)],
    "gold_nav_performance": [("ingestion_date", F.asc), ("daily_return_pct", F.desc)],
    "gold_txn_volume": [
        ("ingestion_date", F.asc),
        ("transaction_type", F.asc),
        ("scheme_code", F.asc),
    ],
    "gold_top_funds": [("rank", F.asc)],
    "summary_nav_by_date": [("ingestion_date", F.asc)],
    "summary_txn_by_date_type": [("ingestion_date", F.asc), ("transaction_type", F.asc)],
}
_SHOWN = {
    "gold_aum_by_fund": 10,
    "gold_nav_performance": 10,
    "gold_txn_volume": 10,
    "gold_top_funds": 20,
}
# What tells rows apart that the order leaves level.
_TIES = {
    "gold_nav_performance": ("scheme_code", "scheme_name"),
    "gold_top_funds": ("scheme_code", "scheme_name"),
}


def nav_by_date(nav: DataFrame) -> DataFrame:
    """Price ticks per day."""
    return nav.groupBy("ingestion_date").agg(F.count("*").alias("count"))


def txn_by_date_type(txn: DataFrame) -> DataFrame:
    """Number and total amount of transactions per day and type."""
    sums = txn.groupBy("ingestion_date", "transaction_type").agg(
        F.count("*").alias("count"), exact_sum("amount").alias("total")
    )
    return sums.select(
        "ingestion_date", "transaction_type", "count", settle(F.col("total"), 2).alias("total_amount")
    )


def silver_counts(nav: DataFrame, txn: DataFrame) -> DataFrame:
    """``(feed, rows)`` of the two silver tables."""
    totals = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("feed"), "rows")
        for name, frame in (("nav", nav), ("txn", txn))
    ]
    return totals[0].union(totals[1])


def silver_summary(nav: DataFrame, txn: DataFrame, sample: int = 5) -> dict[str, DataFrame]:
    """The frames shown after a silver run, each ready to display."""
    reports = {
        "summary_nav_by_date": nav_by_date(nav),
        "summary_txn_by_date_type": txn_by_date_type(txn),
    }
    ordered = {name: frame.orderBy(*display_order(name)) for name, frame in reports.items()}
    return {
        "summary_nav_sample": preview(nav, sample),
        "summary_txn_sample": preview(txn, sample),
        **ordered,
    }


def display_order(table: str) -> list[Column]:
    """Sort columns for showing a table. Sinks do not sort."""
    return [direction(name) for name, direction in _DISPLAY_ORDER[table]]


def total_order(table: str) -> list[Column]:
    """The display order, with what tells apart rows that it leaves level."""
    return [*display_order(table), *map(F.asc, _TIES.get(table, ()))]


def shown(table: str, frame: DataFrame, n: int | None = None) -> DataFrame:
    """The rows shown of a table, in order, with their ``position`` from 1.

    ``n`` defaults to what is usual for the table, or all rows. With a limit only
    the rows shown are numbered; without one see ``positions``.
    """
    order = total_order(table)
    n = n or _SHOWN.get(table)
    if not n:
        return positions(frame, order).withColumn("position", F.col("position").cast("int"))
    place = F.row_number().over(Window.orderBy(*order))
    return frame.orderBy(*order).limit(n).withColumn("position", place)


def preview(frame: DataFrame, n: int = 20, order: list[Column] | None = None) -> DataFrame:
    """The first ``n`` rows, of a given order if there is one."""
    return (frame.orderBy(*order) if order else frame).limit(n)
