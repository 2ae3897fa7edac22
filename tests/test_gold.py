from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fundflow_checks import feeds
from fundflow.operators.prices import fund_daily_returns, fund_days, nav_performance, open_close
from fundflow.operators.quality import verify_gold
from fundflow.operators.ranking import rank_descending, top_funds
from fundflow.operators.summary import display_order, preview, silver_summary
from fundflow.operators.transactions import aum_by_fund, txn_days, txn_volume
from fundflow.plans.gold import gold_tables, shared_gold_tables
from fundflow.plans.silver import silver_nav, silver_txn
from fundflow.schemas import GOLD_SCHEMAS
from fundflow.sources.lake import with_audit
from tests.frames import bronze, rows, ticks, transaction

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def transactions(spark, *sent):
    return silver_txn(bronze(spark, list(sent)))


def test_net_flow(spark):
    txn = transactions(
        spark,
        transaction("A", "BUY", 10.1),
        transaction("B", "BUY", 0.2),
        transaction("C", "SELL", 4.0),
        transaction("D", "REDEEM", 100.0),
    )
    row = aum_by_fund(txn_days(txn)).first().asDict()
    assert row == {
        "scheme_code": 1,
        "ingestion_date": date(2024, 3, 1),
        "net_aum": 6.3,
        "total_buy_amount": 10.3,
        "total_sell_amount": 4.0,
        "total_transactions": 4,
    }


def test_a_day_of_redemptions_counts_but_does_not_flow(spark):
    row = aum_by_fund(txn_days(transactions(spark, transaction(kind="REDEEM")))).first()
    assert (row["net_aum"], row["total_buy_amount"], row["total_sell_amount"]) == (0.0, 0.0, 0.0)
    assert row["total_transactions"] == 1


def test_amounts_too_large_for_exact_sums_are_kept(spark):
    txn = transactions(
        spark, transaction("A", "BUY", 1e20), transaction("B", "SELL", 3e20), transaction("C")
    )
    row = aum_by_fund(txn_days(txn)).first()
    assert (row["net_aum"], row["total_buy_amount"]) == (-2e20, 1e20)
    volume = {r["transaction_type"]: r["total_amount"] for r in txn_volume(txn_days(txn)).collect()}
    assert volume == {"BUY": 1e20, "SELL": 3e20}


def test_volume(spark):
    txn = transactions(
        spark, transaction("A", amount=1.0), transaction("B", amount=2.0), transaction("C", "SELL")
    )
    got = {r["transaction_type"]: tuple(r)[3:] for r in txn_volume(txn_days(txn)).collect()}
    assert got == {"BUY": (2, 3.0, 1.5, 1.0, 2.0), "SELL": (1, 5.0, 5.0, 5.0, 5.0)}


def test_one_tick_day_has_no_volatility(spark):
    nav = ticks(
        spark,
        [
            (1, "a", 10.0, "2024-03-01 10:00:00"),
            (1, "a", 10.0, "2024-03-02 10:00:00"),
            (1, "a", 12.0, "2024-03-02 11:00:00"),
        ],
    )
    days = fund_days(nav)
    got = {r["ingestion_date"].day: r["nav_volatility"] for r in fund_daily_returns(days).collect()}
    assert got == {1: None, 2: 1.4142}
    fund = top_funds(days).first()
    assert (fund["avg_volatility"], fund["trading_days"]) == (1.4142, 2)
    assert (fund["avg_daily_return_pct"], fund["best_daily_return_pct"]) == (10.0, 20.0)


def test_opening_price_that_rounds_to_zero(spark):
    nav = ticks(
        spark,
        [(1, "a", 0.00001, "2024-03-01 10:00:00"), (1, "a", 5.0, "2024-03-01 11:00:00")],
    )
    row = nav_performance(fund_days(nav)).first()
    assert (row["opening_nav"], row["closing_nav"], row["daily_return_pct"]) == (0.0, 5.0, None)


def test_return_uses_rounded_prices(spark):
    nav = ticks(
        spark,
        [(1, "a", 0.00014, "2024-03-01 10:00:00"), (1, "a", 0.00026, "2024-03-01 11:00:00")],
    )
    assert nav_performance(fund_days(nav)).first()["daily_return_pct"] == 200.0


def test_names_of_one_day_share_opening_and_closing(spark):
    nav = ticks(
        spark,
        [
            (1, "old", 10.0, "2024-03-01 09:00:00"),
            (1, "old", 11.0, "2024-03-01 10:00:00"),
            (1, "new", 12.0, "2024-03-01 11:00:00"),
            (1, "new", 15.0, "2024-03-01 12:00:00"),
        ],
    )
    got = {r["scheme_name"]: r for r in nav_performance(fund_days(nav)).collect()}
    assert {(r["opening_nav"], r["closing_nav"]) for r in got.values()} == {(10.0, 15.0)}
    assert (got["old"]["max_nav"], got["new"]["min_nav"]) == (11.0, 12.0)
    assert got["old"]["nav_updates"] == 2


def windowed(nav):
    """Opening and closing price by windows over all ticks, as a check."""
    day = Window.partitionBy("scheme_code", "ingestion_date")
    up, down = day.orderBy("event_timestamp"), day.orderBy(F.desc("event_timestamp"))
    return nav.select(
        "*",
        F.first("nav").over(up).alias("opening_nav"),
        F.first("nav").over(down).alias("closing_nav"),
    )


@pytest.mark.parametrize("renamed", [False, True])
def test_reduced_form_equals_windows(spark, renamed):
    nav = silver_nav(feeds.nav_bronze(spark, MIDDLE, renamed)).persist()
    keys = ["scheme_code", "ingestion_date", "event_timestamp", "nav"]
    prices = [*keys, "opening_nav", "closing_nav"]
    assert rows(open_close(nav).select(*prices)) == rows(windowed(nav).select(*prices))
    names = ["scheme_code", "scheme_name", "ingestion_date"]
    direct = windowed(nav).groupBy(*names).agg(
        F.round(F.any_value("opening_nav"), 4).alias("opening_nav"),
        F.round(F.any_value("closing_nav"), 4).alias("closing_nav"),
        F.count("*").alias("nav_updates"),
    )
    assert rows(fund_days(nav).select(*direct.columns)) == rows(direct)
    nav.unpersist()


def test_missing_day_is_a_day_of_its_own(spark):
    nav = ticks(spark, [(1, "a", 1.0, "2024-03-01 09:00:00")]).withColumn(
        "ingestion_date", F.lit(None).cast("date")
    )
    assert open_close(nav).count() == fund_days(nav).count() == 1


def ranked(spark, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    window = Window.orderBy(F.desc_nulls_last("v"))
    want = frame.withColumn("rank", F.rank().over(window))
    return rows(rank_descending(frame, "v")), rows(want)


def test_rank_shares_ties_and_leaves_gaps(spark):
    got, want = ranked(spark, [3.0, 1.0, 3.0, None, -2.0, 0.0, -0.0, None])
    assert got == want
    assert sorted(r[2] for r in got) == [1, 1, 3, 4, 4, 6, 7, 7]


@pytest.mark.parametrize("seed", range(3))
def test_rank_equals_one_global_window(spark, seed):
    rng = random.Random(seed)
    values = [round(rng.gauss(0, 10 ** rng.randint(-3, 4)), 4) for _ in range(1_500)]
    values += [0.0] * 700 + [None] * 50 + [1e308, -1e308, 1e-4, -1e-4, float("inf")]
    rng.shuffle(values)
    got, want = ranked(spark, values)
    assert got == want


def test_rank_sends_no_row_list_to_one_task(spark):
    """Only the bounded band list is ordered globally."""
    frame = spark.range(100).selectExpr("id", "cast(id as double) as v")
    plan = rank_descending(frame, "v")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2
    unpartitioned = [line for line in windows if "windowspecdefinition(band#" in line
                     and "DESC" in line.split("windowspecdefinition(")[1].split(",")[0]]
    assert len(unpartitioned) == 1


def test_gold_tables_match_their_contracts(spark):
    nav, txn = silver_nav(feeds.nav_bronze(spark, SMALL)), silver_txn(feeds.txn_bronze(spark, SMALL))
    lazily = gold_tables(nav, txn)
    assert set(lazily) == set(GOLD_SCHEMAS)
    with shared_gold_tables(nav, txn) as shared:
        for name, schema in GOLD_SCHEMAS.items():
            assert with_audit(shared[name]).dtypes == [
                (f.name, f.dataType.simpleString()) for f in schema
            ]
            assert rows(shared[name]) == rows(lazily[name])
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_gold_does_not_depend_on_partitioning(spark):
    nav = silver_nav(feeds.nav_bronze(spark, SMALL)).persist()
    txn = silver_txn(feeds.txn_bronze(spark, SMALL)).persist()
    want = {name: rows(frame) for name, frame in gold_tables(nav, txn).items()}
    for n in (1, 16):
        order = F.hash("event_timestamp", F.lit(n))
        again = gold_tables(nav.repartition(n, order), txn.repartition(n, order))
        assert {name: rows(frame) for name, frame in again.items()} == want
    nav.unpersist()
    txn.unpersist()


def test_verify(spark):
    frame = spark.range(3)
    assert verify_gold(frame).first()["total_funds"] == 3
    assert verify_gold(spark.range(0)).first()["total_funds"] == 0
    assert verify_gold(frame, 3).first()["total_funds"] == 3
    with pytest.raises(Exception, match="ranking table has 3 rows, expected 4"):
        verify_gold(frame, 4).collect()


def test_display(spark):
    nav, txn = silver_nav(feeds.nav_bronze(spark, SMALL)), silver_txn(feeds.txn_bronze(spark, SMALL))
    shown = silver_summary(nav, txn)
    assert {name: frame.count() for name, frame in shown.items() if "sample" in name} == {
        "summary_nav_sample": 5,
        "summary_txn_sample": 5,
    }
    days = [r["ingestion_date"] for r in shown["summary_nav_by_date"].collect()]
    assert days == sorted(days)
    performance = nav_performance(fund_days(nav))
    top = preview(performance, 10, display_order("gold_nav_performance")).collect()
    first_day = [r["daily_return_pct"] for r in top if r["ingestion_date"] == days[0]]
    assert first_day == sorted(first_day, reverse=True)
    plan = preview(performance, 10, display_order("gold_nav_performance"))
    assert "TakeOrderedAndProject" in plan._jdf.queryExecution().executedPlan().toString()
