"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local cores. Each
figure is the best of ``BENCH_RUNS`` runs after a warm-up. ``yardstick`` holds
the same work done step by step (see fundflow_checks/stepwise.py) on the same inputs, run
in turns with ours so that neither has the warmer JVM.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from fundflow_checks import feeds, stepwise
from fundflow_checks.queries import REGISTRY
from fundflow.plans import medallion, silver
from fundflow.schemas import NAV, TXN
from fundflow.sources.lake import read_bronze, read_silver, silver_path
from fundflow.sources.warehouse import ParquetWarehouse
from fundflow.sources.workspace import new_folder

# Computed in full and thrown away: no driver collect, no file output.
QUERIES = [
    "silver_nav",
    "silver_txn",
    "silver_txn_quality",
    "gold_open_close",
    "gold_aum_by_fund",
    "gold_nav_performance",
    "gold_txn_volume",
    "gold_top_funds",
    "lineitem_txn_dedup",
    "lineitem_txn_volume",
    "lineitem_net_flow",
]


def session(cpus: str) -> SparkSession:
    work = tempfile.mkdtemp(prefix="fundflow-bench-")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fundflow-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/checkpoint")
        .getOrCreate()
    )


def drop(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")

    def best(*works: Callable[[], object]) -> list[float]:
        """Best time of each piece of work; several are run in turns."""
        times: list[list[float]] = [[] for _ in works]
        for _ in range(1 + runs):
            for work, taken in zip(works, times):
                spark.catalog.clearCache()
                start = time.perf_counter()
                work()
                taken.append(time.perf_counter() - start)
        return [round(min(taken[1:]), 3) for taken in times]

    def config() -> medallion.LakeConfig:
        root = new_folder(spark, "bench")
        return medallion.LakeConfig(root=root, warehouse=ParquetWarehouse(f"{root}/gold"))

    def land(cfg: medallion.LakeConfig) -> None:
        events = feeds.table_stream(spark, sf_dir, "events")
        streams = {"nav": feeds.nav_records(events), "txn": feeds.txn_records(events)}
        medallion.run_bronze(cfg, streams)

    lake = config()
    land(lake)
    medallion.run_silver(spark, lake)
    bronze = {feed.name: read_bronze(spark, lake.bronze(feed)) for feed in (NAV, TXN)}

    def silver_by_steps() -> None:
        out = config()
        for feed in (NAV, TXN):
            typed = silver.typed_rows(bronze[feed.name], feed)
            stepwise.silver_steps(typed, feed, silver_path(out.silver, feed.folder))

    def silver_in_one_pass() -> None:
        medallion.run_silver(spark, replace(lake, silver_root=new_folder(spark, "silver")))

    def gold_by_steps() -> None:
        out = config()
        nav, txn = read_silver(spark, lake.silver)
        for name, frame in stepwise.gold_steps(spark, nav, txn).items():
            out.warehouse.replace(name, frame)
        out.warehouse.read(spark, "gold_top_funds").count()

    def gold_shared() -> None:
        medallion.run_gold(spark, replace(lake, warehouse=ParquetWarehouse(new_folder(spark, "gold"))))

    timed: dict[str, float] = {}
    yardstick: dict[str, float] = {}
    (timed["bronze_two_feeds"],) = best(lambda: land(config()))
    for name, ours, theirs in (
        ("silver_both_feeds", silver_in_one_pass, silver_by_steps),
        ("gold_four_tables", gold_shared, gold_by_steps),
    ):
        timed[name], yardstick[name] = best(ours, theirs)
    for name in QUERIES:

        def ours() -> None:
            drop(REGISTRY[name](spark, sf_dir))

        def theirs() -> None:
            nav = silver.silver_nav(feeds.nav_bronze(spark, sf_dir))
            txn = silver.silver_txn(feeds.txn_bronze(spark, sf_dir))
            if name.startswith("lineitem"):
                txn = feeds.lineitem_transactions(spark, sf_dir)
            drop(stepwise.query_steps(spark, name, nav, txn))

        if name in stepwise.QUERY_STEPS:
            timed[name], yardstick[name] = best(ours, theirs)
        else:
            (timed[name],) = best(ours)
    spark.stop()
    result = {
        "metric": "fundflow_headline_total",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "yardstick": yardstick,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    with contextlib.suppress(BrokenPipeError):
        main()
    sys.stdout.flush()
