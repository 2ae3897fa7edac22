"""One callable per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow_checks import feeds
from fundflow.functions import billionths, moments, sample_deviation
from fundflow.operators import drift, prices, quality, ranking, summary, transactions
from fundflow.operators.dedup import first_per_key
from fundflow.operators.positions import positions
from fundflow.operators.envelope import to_envelope
from fundflow.plans import quarantine, silver
from fundflow.plans.compaction import CompactedBronze
from fundflow.plans.gold_increments import GoldIncrements
from fundflow.plans.increments import SilverIncrements
from fundflow.plans.medallion import LakeConfig, RunReport, run_all
from fundflow.schemas import NAV, TXN, Feed
from fundflow.sources.lake import DAY, by_day, read_bronze, read_silver, silver_path, write_silver
from fundflow.sources.warehouse import SnapshotWarehouse, side_by_side
from fundflow.sources.workspace import new_folder
from fundflow.streaming.landing import await_feeds, ingest_feed

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTRY[query.__name__] = query
    return query


def plain_times(frame: DataFrame) -> DataFrame:
    """Times without a zone, as the SQL side has them."""
    return frame.select(
        *[
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


def _bronze(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    source = feeds.nav_bronze if feed is NAV else feeds.txn_bronze
    return source(spark, sf_dir)


def _typed(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    return silver.typed_rows(_bronze(spark, sf_dir, feed), feed)


def _published(rows: DataFrame, feed: Feed) -> DataFrame:
    return plain_times(rows.select(*feed.silver_columns))


def _nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_nav(feeds.nav_bronze(spark, sf_dir))


def _txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_txn(feeds.txn_bronze(spark, sf_dir))


# Bronze


@register
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(feeds.nav_bronze(spark, sf_dir).union(feeds.txn_bronze(spark, sf_dir)))


def _drain(spark: SparkSession, sf_dir: str, root: str, *names: str) -> None:
    events = feeds.table_stream(spark, sf_dir, "events")
    records = {"nav": feeds.nav_records, "txn": feeds.txn_records}
    queries = [
        ingest_feed(records[name](events), f"{root}/{name}", f"{root}/state/{name}", "drain")
        for name in names
    ]
    await_feeds(queries, "drain")


@register
def bronze_stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "landing")
    _drain(spark, sf_dir, root, "nav")
    return plain_times(read_bronze(spark, f"{root}/nav"))


@register
def bronze_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "restart")
    _drain(spark, sf_dir, root, "nav")
    _drain(spark, sf_dir, root, "nav")
    landed = read_bronze(spark, f"{root}/nav")
    return landed.groupBy("ingestion_date").agg(F.count("*").alias("messages"))


@register
def bronze_stream_two_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "feeds")
    _drain(spark, sf_dir, root, "nav", "txn")
    landed = read_bronze(spark, f"{root}/nav").union(read_bronze(spark, f"{root}/txn"))
    return landed.groupBy("topic", "ingestion_date").agg(F.count("*").alias("messages"))


@register
def bronze_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices landed by the stream, each day then written as one segment."""
    root = new_folder(spark, "compacted")
    _drain(spark, sf_dir, root, "nav")
    table = CompactedBronze(spark, f"{root}/nav", f"{root}/compacted")
    table.compact(least_files=1)
    return plain_times(table.read())


# Silver


@register
def silver_nav_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(_typed(spark, sf_dir, NAV), NAV)


@register
def silver_txn_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(_typed(spark, sf_dir, TXN), TXN)


@register
def silver_nav_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(silver.complete_rows(_bronze(spark, sf_dir, NAV), NAV), NAV)


@register
def silver_txn_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(silver.complete_rows(_bronze(spark, sf_dir, TXN), TXN), TXN)


@register
def silver_nav_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = silver.judged_rows(_bronze(spark, sf_dir, NAV), NAV)
    return _published(judged.filter("rule <> 'required'"), NAV)


@register
def silver_txn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = silver.judged_rows(_bronze(spark, sf_dir, TXN), TXN)
    return _published(judged.filter("rule <> 'required'"), TXN)


@register
def silver_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_nav(spark, sf_dir))


@register
def silver_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(_txn(spark, sf_dir))


@register
def silver_nav_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.nav_quality(feeds.nav_bronze(spark, sf_dir))


@register
def silver_txn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.txn_quality(feeds.txn_bronze(spark, sf_dir))


@register
def silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.silver_counts(_nav(spark, sf_dir), _txn(spark, sf_dir))


@register
def silver_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "silver")
    write_silver(_nav(spark, sf_dir), silver_path(root, NAV.folder))
    write_silver(_txn(spark, sf_dir), silver_path(root, TXN.folder))
    nav, txn = read_silver(spark, root)
    shared = ["scheme_code", "event_timestamp", "ingestion_date", "kafka_topic", "kafka_offset"]
    return plain_times(
        nav.select(*shared, F.col("nav").alias("measure")).union(
            txn.select(*shared, F.col("amount").alias("measure"))
        )
    )


def _stored(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    """A silver table written and read back, with every column of the feed."""
    path = silver_path(new_folder(spark, "silver"), feed.folder)
    rows = _nav(spark, sf_dir) if feed is NAV else _txn(spark, sf_dir)
    write_silver(rows, path)
    return _published(spark.read.schema(feed.silver).parquet(path), feed)


@register
def silver_nav_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, NAV)


@register
def silver_txn_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, TXN)


@register
def summary_nav_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.nav_by_date(_nav(spark, sf_dir))


@register
def summary_txn_by_date_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.txn_by_date_type(_txn(spark, sf_dir))


@register
def summary_nav_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("scheme_code"), F.col("event_timestamp")]
    return plain_times(summary.preview(_nav(spark, sf_dir), 5, order))


@register
def summary_txn_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(summary.preview(_txn(spark, sf_dir), 5, [F.col("transaction_id")]))


@register
def summary_nav_by_date_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("summary_nav_by_date", summary_nav_by_date(spark, sf_dir))


@register
def summary_txn_by_date_type_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("summary_txn_by_date_type", summary_txn_by_date_type(spark, sf_dir))


# Gold


@register
def gold_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(prices.open_close(_nav(spark, sf_dir)))


@register
def gold_aum_by_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions.aum_by_fund(transactions.txn_days(_txn(spark, sf_dir)))


@register
def gold_nav_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.nav_performance(prices.fund_days(_nav(spark, sf_dir)))


@register
def gold_nav_performance_renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nav = silver.silver_nav(feeds.nav_bronze(spark, sf_dir, renamed=True))
    return prices.nav_performance(prices.fund_days(nav))


@register
def gold_txn_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions.txn_volume(transactions.txn_days(_txn(spark, sf_dir)))


@register
def gold_fund_daily_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices.fund_daily_returns(prices.fund_days(_nav(spark, sf_dir)))


@register
def gold_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deviation of each fund's prices on each day."""
    days = prices.fund_days(_nav(spark, sf_dir))
    return days.select("scheme_code", "scheme_name", "ingestion_date", "nav_volatility", "nav_updates")


@register
def lineitem_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.lineitem_transactions(spark, sf_dir).withColumn("whole", billionths("amount"))
    spread = lines.groupBy("scheme_code").agg(moments("amount", "whole").alias("spread"))
    return spread.select("scheme_code", sample_deviation(F.col("spread")).alias("amount_volatility"))


@register
def gold_top_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row per fund, written because the ranking reads it twice.
    path = new_folder(spark, "funds")
    ranking.fund_totals(prices.fund_days(_nav(spark, sf_dir))).write.parquet(path)
    return ranking.rank_descending(spark.read.parquet(path), by="avg_daily_return_pct")


@register
def gold_verify_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verify_gold(gold_top_funds(spark, sf_dir), min_rows=1)


@register
def shown_aum_by_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("gold_aum_by_fund", gold_aum_by_fund(spark, sf_dir))


@register
def shown_nav_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("gold_nav_performance", gold_nav_performance(spark, sf_dir))


@register
def shown_txn_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("gold_txn_volume", gold_txn_volume(spark, sf_dir))


@register
def shown_top_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.shown("gold_top_funds", gold_top_funds(spark, sf_dir))


# What is rejected, and what messages hold


def _rejected(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    path = silver_path(new_folder(spark, "split"), feed.folder)
    quarantine.split_silver(_bronze(spark, sf_dir, feed), feed, path)
    return quarantine.read_rejected(spark, path, feed)


@register
def rejected_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(spark, sf_dir, NAV)


@register
def rejected_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejected(spark, sf_dir, TXN)


@register
def drift_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_drift(_bronze(spark, sf_dir, NAV), NAV)


@register
def drift_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.schema_drift(_bronze(spark, sf_dir, TXN), TXN)


# Places of all rows


@register
def positions_aum_by_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positions(gold_aum_by_fund(spark, sf_dir), summary.total_order("gold_aum_by_fund"))


@register
def positions_nav_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = gold_nav_performance(spark, sf_dir)
    return positions(frame, summary.total_order("gold_nav_performance"))


@register
def positions_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines from the dearest on."""
    lines = feeds.lineitem_transactions(spark, sf_dir)
    order = [F.desc("amount"), F.asc("transaction_id"), *map(F.asc, feeds.LINE_ORDER)]
    return positions(lines, order).select("transaction_id", "amount", "position")


# All layers by one run


_RUNS: dict[tuple[str, str], tuple[LakeConfig, RunReport]] = {}


def _run(spark: SparkSession, sf_dir: str) -> tuple[LakeConfig, RunReport]:
    """One run over all layers for each session and input; the queries below read its files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        root = new_folder(spark, "layers")
        gold = SnapshotWarehouse(f"{root}/gold")
        cfg = LakeConfig(root=root, warehouse=gold, min_funds=1, keep_rejected=True)
        events = feeds.table_stream(spark, sf_dir, "events")
        streams = {"nav": feeds.nav_records(events), "txn": feeds.txn_records(events)}
        _RUNS[key] = cfg, run_all(spark, cfg, streams)
    return _RUNS[key]


def _layer(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    cfg, _ = _run(spark, sf_dir)
    nav, txn = read_silver(spark, cfg.silver, part=cfg.silver_part)
    return _published(nav if feed is NAV else txn, feed)


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    cfg, _ = _run(spark, sf_dir)
    return cfg.warehouse.read(spark, table).drop("processed_at")


@register
def layers_silver_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, NAV)


@register
def layers_silver_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _layer(spark, sf_dir, TXN)


@register
def layers_gold_aum_by_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "gold_aum_by_fund")


@register
def layers_gold_nav_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "gold_nav_performance")


@register
def layers_gold_txn_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "gold_txn_volume")


@register
def layers_gold_top_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold(spark, sf_dir, "gold_top_funds")


@register
def layers_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files of the run say of every message: kept, rejected or repeated."""
    cfg, _ = _run(spark, sf_dir)
    nav, txn = (
        quarantine.stored_quality(spark, silver_path(cfg.silver, feed.folder), feed)
        for feed in (NAV, TXN)
    )
    return nav.union(txn)


@register
def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds through every layer; the number of rows in each table."""
    cfg, _ = _run(spark, sf_dir)
    nav, txn = read_silver(spark, cfg.silver, part=cfg.silver_part)
    tables = {
        "bronze_nav": read_bronze(spark, cfg.bronze(NAV)),
        "bronze_txn": read_bronze(spark, cfg.bronze(TXN)),
        "silver_nav": nav,
        "silver_txn": txn,
    }
    for name in ("gold_aum_by_fund", "gold_nav_performance", "gold_txn_volume", "gold_top_funds"):
        tables[name] = cfg.warehouse.read(spark, name)
    counts = None
    for name, frame in tables.items():
        one = frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        counts = one if counts is None else counts.union(one)
    return counts


# Silver and gold brought up to date in three steps

_STEPS = 3
_BUCKET_KEYS = 500_000
_LAKES: dict[tuple[str, str], tuple[dict[str, SilverIncrements], GoldIncrements]] = {}


def _stepwise_lake(
    spark: SparkSession, sf_dir: str
) -> tuple[dict[str, SilverIncrements], GoldIncrements]:
    """All messages landed in three parts, repeats often before what they repeat.

    After each part silver merges the new files; gold merges the days that changed after the
    first part and after the last.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        root = new_folder(spark, "increments")
        events = feeds.table(spark, sf_dir, "events")
        landed = {
            NAV: to_envelope(feeds.nav_records(events)),
            TXN: to_envelope(feeds.txn_records(events)),
        }
        # A bucket is joined by one task, so their number follows the number of keys.
        buckets = 4 + events.count() // _BUCKET_KEYS
        tables = {
            f.name: SilverIncrements(spark, f, f"{root}/{f.name}", buckets=buckets) for f in landed
        }
        gold = GoldIncrements(spark, f"{root}/gold", tables["nav"], tables["txn"])
        part = F.pmod(F.hash("offset"), F.lit(_STEPS))

        def land(feed: Feed, step: int) -> None:
            path = f"{root}/bronze/{feed.folder}"
            rows = landed[feed].filter(part == step)
            by_day(rows).write.partitionBy(DAY).parquet(path, mode="append")
            tables[feed.name].advance(path)

        for step in range(_STEPS):
            side_by_side(spark, partial(land, step=step), list(landed))
            if step != 1:
                gold.advance()
        _LAKES[key] = tables, gold
    return _LAKES[key]


def _step_silver(spark: SparkSession, sf_dir: str, feed: Feed) -> DataFrame:
    return _published(_stepwise_lake(spark, sf_dir)[0][feed.name].read(), feed)


def _step_gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return _stepwise_lake(spark, sf_dir)[1].read(table).drop("processed_at")


@register
def increments_silver_nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_silver(spark, sf_dir, NAV)


@register
def increments_silver_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_silver(spark, sf_dir, TXN)


@register
def increments_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that each step added, from their files."""
    tables = _stepwise_lake(spark, sf_dir)[0]
    return tables["nav"].quality().union(tables["txn"].quality())


@register
def increments_gold_aum_by_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_gold(spark, sf_dir, "gold_aum_by_fund")


@register
def increments_gold_nav_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_gold(spark, sf_dir, "gold_nav_performance")


@register
def increments_gold_txn_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_gold(spark, sf_dir, "gold_txn_volume")


@register
def increments_gold_top_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _step_gold(spark, sf_dir, "gold_top_funds")


# The larger input


@register
def lineitem_txn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.lineitem_transactions(spark, sf_dir)
    order = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "amount", "l_discount", "l_tax")
    first = first_per_key(lines, ["transaction_id"], order)
    return first.select(
        "transaction_id", "scheme_code", "transaction_type", "amount", "ingestion_date"
    )


@register
def lineitem_txn_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.lineitem_transactions(spark, sf_dir)
    return transactions.txn_volume(transactions.txn_days(lines))


@register
def lineitem_net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.lineitem_transactions(spark, sf_dir)
    return transactions.aum_by_fund(transactions.txn_days(lines))
