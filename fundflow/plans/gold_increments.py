"""Gold kept up to date from the days of silver that changed.

What the gold tables are made of is stored as states, one per fund, name and day
and one per day, type and fund: sums as exact parts, counts, first and last
price. States of added rows merge with the stored ones; a day that silver wrote
again is reduced anew. The tables are then published from all states, and one
commit makes states and tables visible together. Ticks of unchanged days are not
read. The tables are those of a full run, to the last digit.

States are read as they were written. ``STATE_SCHEMA`` names their layout and is
part of each commit: states of another layout are not merged but made anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fundflow.operators.prices import fund_day_states, merge_fund_days, published_fund_days
from fundflow.operators.ranking import top_funds
from fundflow.operators.transactions import aum_by_fund, merge_txn_days, txn_days, txn_volume
from fundflow.plans.increments import SilverIncrements
from fundflow.schemas import NAV, TXN, Feed
from fundflow.sources.lake import with_audit
from fundflow.sources.segments import (
    changed_days,
    new_segment,
    read_segments,
    with_added,
    without,
    write_segment,
)
from fundflow.sources.snapshots import Snapshots, Version
from fundflow.sources.warehouse import side_by_side
from fundflow.sources.workspace import new_folder

#: The layout of stored states. Raise it with any change to the columns of a state.
STATE_SCHEMA = 1


@dataclass(frozen=True)
class Reduction:
    """How rows of a feed become states, and states of one key one state."""

    feed: Feed
    reduce: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


REDUCTIONS = (
    Reduction(NAV, fund_day_states, merge_fund_days),
    Reduction(TXN, txn_days, merge_txn_days),
)


class GoldIncrements:
    """The four gold tables below ``root``, from two incremental silver tables."""

    def __init__(self, spark: SparkSession, root: str, nav: SilverIncrements, txn: SilverIncrements):
        self.spark, self.root = spark, root.rstrip("/")
        self.silver = {NAV.name: nav, TXN.name: txn}
        self.versions = Snapshots(spark, self.root)

    def _usable(self, version: Version) -> dict:
        empty = {"schema": STATE_SCHEMA, "silver": {}, "states": {}, "tables": {}}
        usable = version.content.get("schema") == STATE_SCHEMA
        return version.content if usable else {**empty, "tables": version.content.get("tables", {})}

    def advance(self) -> Version:
        """Merge what silver has committed since, and publish the four tables."""
        before = self.versions.current()
        content = dict(self._usable(before))
        done = dict(side_by_side(self.spark, lambda r: self._merge_feed(r, content), REDUCTIONS))
        content["silver"] = {name: silver for name, (silver, _) in done.items()}
        content["states"] = {name: states for name, (_, states) in done.items()}
        tables = self._tables(content["states"])
        folders = {name: self.versions.folder(name) for name in tables}
        side_by_side(
            self.spark,
            lambda name: with_audit(tables[name]).write.parquet(folders[name]),
            list(tables),
        )
        content["tables"] = {**content["tables"], **folders}
        return self.versions.commit(content, before)

    def _states_at(self, feed: Feed) -> str:
        return f"{self.root}/states/{feed.name}"

    def states(self, feed: Feed, live: dict[str, list[str]]) -> DataFrame:
        reduction = next(r for r in REDUCTIONS if r.feed is feed)
        schema = reduction.reduce(self.spark.createDataFrame([], feed.silver)).schema
        return read_segments(self.spark, self._states_at(feed), schema, live)

    def _merge_feed(self, reduction: Reduction, content: dict) -> tuple[str, tuple[dict, dict]]:
        """The silver days now merged, and the live segments of the feed's states."""
        feed, source = reduction.feed, self.silver[reduction.feed.name]
        now = source.live()
        merged = content["silver"].get(feed.name, {})
        live = content["states"].get(feed.name, {})
        added, replaced, gone = changed_days(merged, now)
        live = without(live, [*replaced, *gone])
        if added or replaced:
            rows = read_segments(self.spark, source.rows_at, feed.silver, {**added, **replaced})
            fresh = reduction.reduce(rows)
            touched = {d: live[d] for d in added if d in live}
            if touched:
                fresh = reduction.merge(fresh.unionByName(self.states(feed, touched)))
            segment = new_segment()
            write_segment(fresh, self._states_at(feed), segment)
            live = with_added(without(live, touched), segment, [*added, *replaced])
        return feed.name, (now, live)

    def _tables(self, states: dict[str, dict]) -> dict[str, DataFrame]:
        # Written, because performance reads it once and the ranking twice.
        days = published_fund_days(self.states(NAV, states[NAV.name]), stored=True)
        path = new_folder(self.spark, "days")
        days.write.parquet(path)
        days = self.spark.read.schema(days.schema).parquet(path)
        transactions = self.states(TXN, states[TXN.name])
        return {
            "gold_aum_by_fund": aum_by_fund(transactions),
            "gold_nav_performance": days.drop("nav_volatility"),
            "gold_txn_volume": txn_volume(transactions),
            "gold_top_funds": top_funds(days),
        }

    def read(self, table: str) -> DataFrame:
        """A gold table of the last commit."""
        content = self.versions.current().content
        if table not in content.get("tables", {}):
            raise ValueError(f"no table {table} below {self.root}")
        return self.spark.read.parquet(content["tables"][table])
