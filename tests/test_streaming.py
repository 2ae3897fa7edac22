from __future__ import annotations

import threading
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundflow.plans import medallion
from fundflow.schemas import KAFKA_SCHEMA, NAV, NAV_TOPIC, TXN
from fundflow.sources.kafka import kafka_options
from fundflow.sources.lake import read_bronze
from fundflow.sources.warehouse import ParquetWarehouse
from fundflow.sources.workspace import new_folder
from fundflow.streaming import landing
from fundflow.streaming.landing import await_feeds, ingest_feed, stop_feeds
from tests.frames import bronze, price, rows, transaction

LATE = datetime(2024, 3, 2, 8, 0)


def send(spark, folder, sent):
    spark.createDataFrame(sent, KAFKA_SCHEMA).write.mode("append").parquet(folder)


def source(spark, folder):
    return spark.readStream.schema(KAFKA_SCHEMA).parquet(folder)


def drain(spark, folder, root):
    query = ingest_feed(source(spark, folder), f"{root}/bronze", f"{root}/state", "drain")
    await_feeds([query], "drain")


def test_restart_lands_only_what_is_new(spark):
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    first = [price(offset=0), price(offset=1, sent=LATE)]
    send(spark, folder, first)
    drain(spark, folder, root)
    drain(spark, folder, root)
    landed = read_bronze(spark, f"{root}/bronze")
    assert rows(landed) == rows(bronze(spark, first))
    assert {p.name for p in Path(f"{root}/bronze").glob("ingestion_date=*")} == {
        "ingestion_date=2024-03-01",
        "ingestion_date=2024-03-02",
    }
    send(spark, folder, [price(offset=2, sent=LATE)])
    drain(spark, folder, root)
    offsets = [r["offset"] for r in read_bronze(spark, f"{root}/bronze").collect()]
    assert sorted(offsets) == [0, 1, 2]


def test_late_message_goes_to_its_own_day(spark):
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    for n, sent in enumerate((LATE, datetime(2024, 3, 1, 0, 0))):
        send(spark, folder, [price(offset=n, sent=sent)])
        drain(spark, folder, root)
    days = read_bronze(spark, f"{root}/bronze").groupBy("ingestion_date").count().collect()
    assert sorted(str(r["ingestion_date"]) for r in days) == ["2024-03-01", "2024-03-02"]


def test_continuous_runs_until_stopped(spark):
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    send(spark, folder, [price()])
    query = ingest_feed(source(spark, folder), f"{root}/bronze", f"{root}/state", "continuous")
    query.processAllAvailable()
    assert query.isActive
    assert stop_feeds([query]) == []
    assert not query.isActive
    assert read_bronze(spark, f"{root}/bronze").count() == 1


def test_continuous_ends_with_the_first_of_its_own_queries(spark, monkeypatch):
    monkeypatch.setattr(landing, "POLL_SECONDS", 1)
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    send(spark, folder, [price()])
    drain(spark, folder, f"{root}/earlier")  # an ended query of the session does not count
    queries = [
        ingest_feed(source(spark, folder), f"{root}/{n}", f"{root}/state{n}", "continuous")
        for n in range(2)
    ]
    stopper = threading.Timer(3, queries[1].stop)
    stopper.start()
    began = time.monotonic()
    await_feeds(queries, "continuous")
    assert time.monotonic() - began > 1 and queries[0].isActive
    stop_feeds(queries)
    stopper.join()


def test_stopping_goes_on_past_errors():
    class Query:
        def __init__(self, error=None):
            self.error, self.stopped = error, False

        def stop(self):
            if self.error:
                raise self.error
            self.stopped = True

    error = RuntimeError("stuck")
    queries = [Query(error), Query()]
    assert stop_feeds(queries) == [error]
    assert queries[1].stopped


def lake(spark, **options):
    root = new_folder(spark, "lake")
    return medallion.LakeConfig(root=root, warehouse=ParquetWarehouse(f"{root}/gold"), **options)


def topics(spark):
    folders = {"nav": new_folder(spark, "nav"), "txn": new_folder(spark, "txn")}
    send(spark, folders["nav"], [price(offset=0), price(at="2024-03-01 11:00:00", nav=11.0, offset=1)])
    send(spark, folders["txn"], [transaction(), transaction(id="T2", kind="SELL", amount=1.0)])
    return {name: source(spark, folder) for name, folder in folders.items()}


def test_run_over_all_layers_twice(spark):
    cfg, streams = lake(spark, min_funds=1), topics(spark)
    for _ in range(2):
        report = medallion.run_all(spark, cfg, streams)
        assert report.total_funds == 1
        assert report.quality["nav"] == {
            "read": 2, "required": 0, "duplicate": 0, "not_positive": 0, "kept": 2,
        }
        assert report.quality["txn"]["kept"] == 2
        performance = cfg.warehouse.read(spark, "gold_nav_performance").collect()
        assert [r["daily_return_pct"] for r in performance] == [10.0]
        flow = cfg.warehouse.read(spark, "gold_aum_by_fund").collect()
        assert [r["net_aum"] for r in flow] == [4.0]
        assert performance[0]["processed_at"] is not None


def test_a_failing_feed_ends_the_run_and_the_other_feed(spark):
    cfg, streams = lake(spark), topics(spark)
    fails = F.raise_error(F.lit("feed is broken"))
    streams["txn"] = streams["txn"].withColumn("topic", fails.cast("string"))
    with pytest.raises(Exception, match="feed is broken"):
        medallion.run_all(spark, cfg, streams)
    assert spark.streams.active == []
    assert not Path(cfg.silver).exists()


def test_too_few_funds_end_the_run(spark):
    with pytest.raises(Exception, match="expected 2"):
        medallion.run_all(spark, lake(spark, min_funds=2), topics(spark))


def test_layer_paths():
    cfg = medallion.LakeConfig(root="s3a://lake", warehouse=ParquetWarehouse("x"))
    assert cfg.bronze(NAV) == "s3a://lake/bronze/nav_data"
    assert cfg.checkpoint(TXN) == "s3a://lake/checkpoints/transaction_data"
    assert cfg.silver == "s3a://lake/silver"


def test_topic_options():
    assert kafka_options(NAV_TOPIC, "broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "nav_raw",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    busy = kafka_options(NAV_TOPIC, "b", "latest", True, {"maxOffsetsPerTrigger": "1000000"})
    assert (busy["startingOffsets"], busy["failOnDataLoss"]) == ("latest", "true")
    assert busy["maxOffsetsPerTrigger"] == "1000000"


def test_topics_need_the_connector(spark):
    """The connector is not part of this image; the reader asks for it by name."""
    cfg = medallion.LakeConfig(root="x", warehouse=ParquetWarehouse("x"), servers="b:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        medallion.topic_streams(spark, cfg)


def test_a_batch_writes_a_bounded_number_of_files_per_day(spark):
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    sent = [price(offset=k, sent=LATE) for k in range(60)]
    spark.createDataFrame(sent, KAFKA_SCHEMA).repartition(12).write.parquet(folder)
    query = ingest_feed(
        source(spark, folder), f"{root}/bronze", f"{root}/state", "drain", files_per_day=3
    )
    await_feeds([query], "drain")
    assert 1 <= len(list(Path(f"{root}/bronze").glob("*/*.parquet"))) <= 3
    assert read_bronze(spark, f"{root}/bronze").count() == 60


def test_a_small_day_is_not_cut_into_many_files(spark):
    folder, root = new_folder(spark, "topic"), new_folder(spark, "land")
    sent = [price(offset=k, sent=LATE) for k in range(60)]
    spark.createDataFrame(sent, KAFKA_SCHEMA).repartition(12).write.parquet(folder)
    query = ingest_feed(source(spark, folder), f"{root}/bronze", f"{root}/state", "drain")
    await_feeds([query], "drain")
    assert len(list(Path(f"{root}/bronze").glob("*/*.parquet"))) == 1
    assert read_bronze(spark, f"{root}/bronze").count() == 60


def test_another_zone_is_refused(spark):
    cfg = medallion.LakeConfig(root="x", warehouse=ParquetWarehouse("x"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for run in (
            lambda: medallion.run_all(spark, cfg, {}),
            lambda: medallion.run_silver(spark, cfg),
            lambda: medallion.run_bronze(cfg, {"nav": spark.range(1)}),
        ):
            with pytest.raises(ValueError, match="not UTC"):
                run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_query_that_will_not_stop_is_reported(monkeypatch, spark):
    stuck = RuntimeError("stuck")
    monkeypatch.setattr(medallion, "ingest_feed", lambda *_: None)
    monkeypatch.setattr(medallion, "await_feeds", lambda *_: None)
    monkeypatch.setattr(medallion, "stop_feeds", lambda _: [stuck])
    cfg = medallion.LakeConfig(root="x", warehouse=ParquetWarehouse("x"))
    with pytest.raises(RuntimeError, match="stuck"):
        medallion.run_bronze(cfg, {"nav": spark.range(1), "txn": spark.range(1)})


def test_periods_have_folders_of_their_own():
    cfg = medallion.LakeConfig("r", ParquetWarehouse("w"), period="2024-04", earlier=("2024-03",))
    assert cfg.bronze(NAV) == f"r/bronze/{NAV.folder}-2024-04"
    assert cfg.all_bronze(NAV) == [f"r/bronze/{NAV.folder}-{m}" for m in ("2024-03", "2024-04")]
    assert cfg.checkpoint(NAV).endswith("-2024-04")
