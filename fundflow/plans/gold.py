"""Silver to gold: four tables from two scans."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from fundflow.operators.prices import (
    fund_day_states,
    fund_days,
    nav_performance,
    published_fund_days,
)
from fundflow.operators.ranking import top_funds
from fundflow.operators.transactions import aum_by_fund, txn_days, txn_volume


def gold_tables(nav: DataFrame, txn: DataFrame) -> dict[str, DataFrame]:
    """The gold tables by name, lazily."""
    return _tables(fund_days(nav), txn_days(txn))


def _tables(nav_days: DataFrame, transaction_days: DataFrame) -> dict[str, DataFrame]:
    return {
        "gold_aum_by_fund": aum_by_fund(transaction_days),
        "gold_nav_performance": nav_performance(nav_days),
        "gold_txn_volume": txn_volume(transaction_days),
        "gold_top_funds": top_funds(nav_days),
    }


@contextmanager
def shared_gold_tables(nav: DataFrame, txn: DataFrame) -> Iterator[dict[str, DataFrame]]:
    """The gold tables for use within the block, each feed scanned once.

    The daily frames are kept for the duration of the block. They hold a row per
    fund and day (and type), not the ticks, may spill to disk, and are computed
    again from silver where an executor is lost.
    """
    states = fund_day_states(nav).persist(StorageLevel.MEMORY_AND_DISK)
    days = published_fund_days(states, stored=True).persist(StorageLevel.MEMORY_AND_DISK)
    flows = txn_days(txn).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield _tables(days, flows)
    finally:
        for frame in (days, states, flows):
            frame.unpersist()
