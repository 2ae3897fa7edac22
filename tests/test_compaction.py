from __future__ import annotations

from datetime import datetime

import pytest

from fundflow.plans.compaction import CompactedBronze
from fundflow.schemas import KAFKA_SCHEMA
from fundflow.sources.lake import read_bronze
from fundflow.sources.snapshots import Snapshots
from fundflow.sources.workspace import new_folder
from fundflow.streaming.landing import await_feeds, ingest_feed
from tests.frames import price, rows


class Feed:
    """A feed that lands in batches."""

    def __init__(self, spark):
        self.spark, self.n = spark, 0
        self.topic, self.root = new_folder(spark, "topic"), new_folder(spark, "lake")
        self.bronze = f"{self.root}/bronze"

    def land(self, *days):
        sent = [price(offset=self.n * 100 + k, sent=datetime(2024, 3, d, 12)) for k, d in enumerate(days)]
        self.spark.createDataFrame(sent, KAFKA_SCHEMA).coalesce(1).write.parquet(self.topic, mode="append")
        self.n += 1
        stream = self.spark.readStream.schema(KAFKA_SCHEMA).parquet(self.topic)
        await_feeds([ingest_feed(stream, self.bronze, f"{self.root}/state", "drain")], "drain")

    def table(self):
        return CompactedBronze(self.spark, self.bronze, f"{self.root}/compacted")


def files(table):
    return {r["day"]: r["files"] for r in table.files_per_day().collect()}


def same(spark, feed):
    assert rows(feed.table().read()) == rows(read_bronze(spark, feed.bronze))


def test_days_are_compacted_while_the_stream_goes_on(spark):
    feed = Feed(spark)
    table = feed.table()
    feed.land()
    assert table.read().count() == 0 and table.compact() == []
    for _ in range(3):
        feed.land(1, 1, 1, 2)
    before = files(table)
    assert before["2024-03-01"] >= 3 and before["2024-03-02"] == 3
    assert table.compact() == ["2024-03-01", "2024-03-02"]
    assert files(table) == {"2024-03-01": 1, "2024-03-02": 1}
    same(spark, feed)
    # A batch that comes later is read beside the segments, then taken in.
    feed.land(2, 3)
    same(spark, feed)
    assert files(table) == {"2024-03-01": 1, "2024-03-02": 2, "2024-03-03": 1}
    assert table.compact() == []
    feed.land(2)
    assert table.compact(["2024-03-02", "2024-03-03"]) == ["2024-03-02"]
    assert files(table) == {"2024-03-01": 1, "2024-03-02": 1, "2024-03-03": 1}
    same(spark, feed)


def test_the_log_of_the_sink_is_read_when_it_was_compacted(spark):
    feed = Feed(spark)
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        for day in (1, 1, 2, 1, 1):
            feed.land(day)
            same(spark, feed)
        assert feed.table().compact() == ["2024-03-01"]
        feed.land(1)
        same(spark, feed)
        assert files(feed.table()) == {"2024-03-01": 2, "2024-03-02": 1}
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")


def test_a_batch_that_lands_during_a_compaction_is_not_lost(spark, monkeypatch):
    feed = Feed(spark)
    for _ in range(2):
        feed.land(1)
    commit = Snapshots.commit
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "commit", lambda *a: (feed.land(1), commit(*a))[1])
        feed.table().compact()
    assert feed.table().read().count() == 3 and files(feed.table()) == {"2024-03-01": 2}
    same(spark, feed)


def test_a_compaction_that_fails_changes_nothing(spark, monkeypatch):
    feed = Feed(spark)
    for _ in range(2):
        feed.land(1)
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            feed.table().compact()
    assert files(feed.table()) == {"2024-03-01": 2}
    same(spark, feed)
