"""Net flow and volume from transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions import add_up, exact_sum, mean_of, minus, settle


def txn_days(txn: DataFrame) -> DataFrame:
    """Transactions reduced to one row per day, type and fund.

    Counts and totals merge map-side, so a hot fund shuffles one row per task.
    Both transaction tables are computed from this frame; ``total`` is an exact
    sum, not yet rounded.
    """
    return txn.groupBy("ingestion_date", "transaction_type", "scheme_code").agg(
        F.count("*").alias("txn_count"),
        F.count("amount").alias("amounts"),
        exact_sum("amount").alias("total"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def merge_txn_days(states: DataFrame) -> DataFrame:
    """States of the same day, type and fund as one: what all their transactions together would give."""
    return states.groupBy("ingestion_date", "transaction_type", "scheme_code").agg(
        F.sum("txn_count").alias("txn_count"),
        F.sum("amounts").alias("amounts"),
        F.when(F.sum("amounts") > 0, add_up("total")).alias("total"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    )


def aum_by_fund(days: DataFrame) -> DataFrame:
    """Net, bought and sold amount per fund and day, from ``txn_days``.

    "AUM" is the net flow of the day, not a running balance. REDEEM adds nothing
    to any amount and is counted in ``total_transactions``.
    """

    def of(kind: str) -> Column:
        return F.coalesce(F.col("transaction_type") == kind, F.lit(False))

    def flow(kind: str, column: str) -> Column:
        # A row of another type counts as 0, one of this type without an amount as nothing.
        known = F.count(F.when(~of(kind) | F.col("total").isNotNull(), 1)) > 0
        return F.when(known, add_up(column))

    parted = days.withColumns(
        {"buys": F.when(of("BUY"), F.col("total")), "sells": F.when(of("SELL"), F.col("total"))}
    )
    flows = parted.groupBy("scheme_code", "ingestion_date").agg(
        flow("BUY", "buys").alias("bought"),
        flow("SELL", "sells").alias("sold"),
        F.sum("txn_count").alias("total_transactions"),
    )
    return flows.withColumn("net", minus("bought", "sold")).select(
        "scheme_code",
        "ingestion_date",
        settle(F.col("net"), 2).alias("net_aum"),
        settle(F.col("bought"), 2).alias("total_buy_amount"),
        settle(F.col("sold"), 2).alias("total_sell_amount"),
        "total_transactions",
    )


def txn_volume(days: DataFrame) -> DataFrame:
    """Count, total, mean and range per day, type and fund, from ``txn_days``."""
    total, n = F.col("total"), F.col("amounts")
    return days.select(
        "ingestion_date",
        "transaction_type",
        "scheme_code",
        "txn_count",
        settle(total, 2).alias("total_amount"),
        mean_of(total, n, 2).alias("avg_amount"),
        F.round("min_amount", 2).alias("min_amount"),
        F.round("max_amount", 2).alias("max_amount"),
    )
