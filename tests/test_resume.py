from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundflow.plans import medallion, resume
from fundflow.schemas import KAFKA_SCHEMA, NAV
from fundflow.sources.files import listing_digest
from fundflow.sources.lake import read_bronze
from fundflow.sources.warehouse import ParquetWarehouse, SnapshotWarehouse
from fundflow.sources.workspace import new_folder
from fundflow.streaming import offsets
from fundflow.streaming.landing import await_feeds, ingest_feed
from tests.frames import message, price, transaction


def send(spark, folder, sent):
    spark.createDataFrame(sent, KAFKA_SCHEMA).coalesce(1).write.parquet(folder, mode="append")


@pytest.fixture
def topics(spark):
    folders = {"nav": new_folder(spark, "nav"), "txn": new_folder(spark, "txn")}
    send(spark, folders["nav"], [price(offset=0)])
    send(spark, folders["txn"], [transaction()])
    streams = {n: spark.readStream.schema(KAFKA_SCHEMA).parquet(f) for n, f in folders.items()}
    return folders, streams


def test_a_run_goes_on_where_it_failed(spark, topics, monkeypatch):
    folders, streams = topics
    root = new_folder(spark, "lake")
    cfg = medallion.LakeConfig(root=root, warehouse=SnapshotWarehouse(f"{root}/gold"))
    done = []
    for layer in ("run_silver", "run_gold"):
        work = getattr(medallion, layer)
        monkeypatch.setattr(
            medallion, layer, lambda *a, work=work, layer=layer: (done.append(layer), work(*a))[1]
        )
    with monkeypatch.context() as patch:
        patch.setattr(medallion, "run_gold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            resume.resume_all(spark, cfg, streams)
    assert done == ["run_silver"]
    report = resume.resume_all(spark, cfg, streams)
    assert done == ["run_silver", "run_gold"]
    assert (report.quality["nav"]["kept"], report.total_funds) == (1, 1)
    # Nothing new: nothing is made, and the report is the last one.
    assert resume.resume_all(spark, cfg, streams) == report
    assert done == ["run_silver", "run_gold"]
    send(spark, folders["nav"], [price(fund=2, offset=1)])
    assert resume.resume_all(spark, cfg, streams).total_funds == 2
    assert done == ["run_silver", "run_gold"] * 2
    # Silver that somebody changed is made again, and gold with it.
    next(Path(cfg.silver).glob("*/*/*.parquet")).unlink()
    assert resume.resume_all(spark, cfg, streams).total_funds == 2
    assert done == ["run_silver", "run_gold"] * 3


def test_digests_of_listings(spark):
    path = new_folder(spark, "files")
    assert listing_digest(spark, path) == "none"
    spark.range(3).write.parquet(path)
    first = listing_digest(spark, path)
    assert first == listing_digest(spark, path, f"{path}-absent")
    spark.range(3).write.parquet(path, mode="append")
    assert listing_digest(spark, path) != first


def log_source(folder):
    """A topic of one partition over numbered files, as a streaming source that begins at given offsets."""
    from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, starting):
            self.starting = starting

        def initialOffset(self):
            return {"nav_raw": {"0": 0}} if self.starting == "earliest" else json.loads(self.starting)

        def read(self, start):
            from pathlib import Path

            lines = [json.loads(x) for f in sorted(Path(folder).glob("*.json")) for x in f.read_text().splitlines()]
            at = start["nav_raw"]["0"]
            return iter([(i, x) for i, x in enumerate(lines) if i >= at]), {"nav_raw": {"0": max(at, len(lines))}}

        def readBetweenOffsets(self, start, end):
            rows, _ = self.read(start)
            return iter([r for r in rows if r[0] < end["nav_raw"]["0"]])

    class Log(DataSource):
        @classmethod
        def name(cls):
            return "test_log"

        def schema(self):
            return "offset long, value string"

        def simpleStreamReader(self, schema):
            return Reader(self.options.get("startingOffsets", "earliest"))

    return Log


def test_a_new_period_begins_where_the_last_one_ended(spark):
    topic = Path(new_folder(spark, "topic").removeprefix("file:"))
    topic.mkdir(parents=True)
    spark.dataSource.register(log_source(str(topic)))
    root = new_folder(spark, "lake")

    def land(cfg):
        starting = medallion.starting_offsets(spark, cfg, NAV)
        lines = spark.readStream.format("test_log").option("startingOffsets", starting).load()
        key, _, name, partition, _, sent = message("x", "nav_raw")
        records = lines.select(
            F.lit(key).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
            F.lit(name).alias("topic"), F.lit(partition).alias("partition"), "offset",
            F.lit(sent).alias("timestamp"),
        )
        # A simple source has no end, so it is drained by waiting for what is there.
        query = ingest_feed(records, cfg.bronze(NAV), cfg.checkpoint(NAV), "continuous", "0 seconds")
        query.processAllAvailable()
        query.stop()

    def write(number, texts):
        (topic / f"{number}.json").write_text("".join(json.dumps(t) + "\n" for t in texts))

    first = medallion.LakeConfig(root, ParquetWarehouse("x"), period="a")
    second = medallion.LakeConfig(root, ParquetWarehouse("x"), period="b", earlier=("a",))
    assert medallion.starting_offsets(spark, first, NAV) == "earliest"
    assert medallion.starting_offsets(spark, second, NAV) == "earliest"
    write(1, ["m0", "m1", "m2"])
    land(first)
    write(2, ["m3"])
    land(first)
    assert json.loads(medallion.starting_offsets(spark, second, NAV)) == {"nav_raw": {"0": 4}}
    write(3, ["m4", "m5"])
    land(second)
    landed = read_bronze(spark, second.all_bronze(NAV))
    assert sorted((r["offset"], r["json_payload"]) for r in landed.collect()) == [(k, f"m{k}") for k in range(6)]
    assert read_bronze(spark, second.bronze(NAV)).count() == 2


def test_a_batch_counts_once_readers_see_it(spark):
    root = Path(new_folder(spark, "logs").removeprefix("file:"))
    for name, batches in (("state/offsets", "0123"), ("state/commits", "01"), ("out/_spark_metadata", "012")):
        (root / name).mkdir(parents=True)
        for n in batches:
            (root / name / n).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{{"t":{{"0":{n}}}}}\n-\n')
    checkpoint, sink = f"{root}/state", f"{root}/out"
    assert offsets.committed_offsets(spark, checkpoint) == ['{"t":{"0":1}}']
    # The sink has batch 2 already; batch 3 was only planned.
    assert offsets.committed_offsets(spark, checkpoint, sink) == ['{"t":{"0":2}}']
    assert offsets.committed_offsets(spark, f"{root}/absent") == []
    (root / "out/_spark_metadata/3.compact").write_text("v1\n")
    assert offsets.last_batch(spark, checkpoint, sink) == 3


def test_offsets_of_a_drained_feed(spark, topics):
    _, streams = topics
    root = new_folder(spark, "lake")
    query = ingest_feed(streams["nav"], f"{root}/bronze", f"{root}/state", "drain")
    await_feeds([query], "drain")
    assert [json.loads(x) for x in offsets.committed_offsets(spark, f"{root}/state", f"{root}/bronze")] == [{"logOffset": 0}]
