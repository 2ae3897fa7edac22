"""One key with a third of all rows, and partitions small enough to show it."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundflow.operators.prices import fund_day_states, fund_days, open_close, published_fund_days
from fundflow.operators.ranking import rank_descending
from fundflow.operators.transactions import aum_by_fund, txn_days
from fundflow.plans.settings import cluster_settings
from fundflow.sources.lake import write_silver
from fundflow.sources.workspace import new_folder
from tests.frames import plan_text, rows

ROWS = 120_000


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def small_partitions(spark):
    return settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


@pytest.fixture(scope="module")
def hot_ticks(spark):
    path = new_folder(spark, "ticks")
    spark.range(ROWS).selectExpr(
        "if(id % 3 = 0, 7, cast(id % 300 as int)) as scheme_code",
        "'F' as scheme_name",
        "cast(id % 977 + 1 as double) as nav",
        "timestamp_seconds(1709251200 + id) as event_timestamp",
        "if(id % 3 = 0, date'2024-03-01', date_add(date'2024-03-02', cast(id % 20 as int)))"
        " as ingestion_date",
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def test_ticks_of_a_hot_day_are_split_between_tasks(spark, hot_ticks):
    with small_partitions(spark):
        joined = open_close(hot_ticks).persist()
        assert joined.count() == ROWS
        hot = joined.filter("scheme_code = 7 and ingestion_date = date'2024-03-01'")
        assert hot.select("opening_nav", "closing_nav").distinct().count() == 1
        joined.unpersist()
        again = open_close(hot_ticks)
        again.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(again)


def test_hot_group_is_reduced_before_the_shuffle(spark, hot_ticks):
    txn = hot_ticks.select(
        "scheme_code", "ingestion_date", F.lit("BUY").alias("transaction_type"),
        F.col("nav").alias("amount"),
    )
    for frame, partial in (
        (fund_days(hot_ticks), "partial_min_by(nav"),
        (aum_by_fund(txn_days(txn)), "partial_sum("),
    ):
        plan = plan_text(frame)
        first_exchange = plan.rindex("Exchange hashpartitioning")
        below = plan[first_exchange:]
        assert partial in below and "HashAggregate" in below
        assert "SortAggregate" not in plan


def test_a_fund_day_with_a_third_of_all_names_is_split(spark):
    path = new_folder(spark, "states")
    names = spark.range(ROWS // 4).selectExpr(
        "if(id % 3 = 0, 7, cast(id % 300 as int)) as scheme_code",
        "concat('F', id) as scheme_name",
        "cast(id % 977 + 1 as double) as nav",
        "timestamp_seconds(1709251200 + id) as event_timestamp",
        "date'2024-03-01' as ingestion_date",
    )
    fund_day_states(names).repartition(8).write.parquet(path)
    states = spark.read.parquet(path)
    columns = ["scheme_code", "scheme_name", "opening_nav", "closing_nav", "nav_volatility"]
    want = rows(published_fund_days(states).select(*columns))
    with small_partitions(spark):
        days = published_fund_days(states, stored=True).select(*columns)
        assert rows(days) == want
        assert "SortMergeJoin(skew=true)" in plan_text(days) and "Window" not in plan_text(days)


def test_a_value_shared_by_a_third_of_the_funds(spark):
    path = new_folder(spark, "funds")
    spark.range(ROWS).selectExpr(
        "id", "if(id % 3 = 0, 0.0, cast(id % 5000 as double) / 100 - 20) as v"
    ).repartition(8).write.parquet(path)
    funds = spark.read.parquet(path)
    with small_partitions(spark):
        frame = rank_descending(funds, "v")
        ranks = {r["v"]: r for r in frame.groupBy("v").agg(
            F.min("rank").alias("rank"), F.max("rank").alias("last"), F.count("*").alias("n")
        ).collect()}
        frame.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(frame)
    above = 0
    for value in sorted(ranks, reverse=True):
        assert ranks[value]["rank"] == ranks[value]["last"] == above + 1
        above += ranks[value]["n"]
    assert above == ROWS


def test_a_hot_day_is_written_by_several_tasks(spark, hot_ticks):
    path = new_folder(spark, "silver")
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200k"):
        write_silver(hot_ticks, path)
    files = {day.name: len(list(day.glob("*.parquet"))) for day in Path(path).glob("*=*")}
    hot = files.pop("ingestion_date=2024-03-01")
    # Days that share the hot day's partition are split with it, others stay whole.
    assert hot > 1 and min(files.values()) == 1
    assert spark.read.parquet(path).count() == ROWS


def test_settings_grow_with_the_data():
    small = cluster_settings(10**9, cores=16)
    large = cluster_settings(100 * 10**12, cores=8_000)
    assert small["spark.sql.shuffle.partitions"] == "32"
    assert int(large["spark.sql.shuffle.partitions"]) > 400_000
    assert large["spark.sql.session.timeZone"] == "UTC"
