from __future__ import annotations

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundflow.plans.silver import build_silver, silver_nav, silver_txn
from fundflow.schemas import NAV, SILVER_NAV_SCHEMA, TXN
from fundflow.sources import lake, warehouse, workspace
from tests.frames import bronze, plan_text, price, rows, transaction


def days(spark, *numbers):
    sent = [
        price(at=f"2024-03-{d:02} 10:00:00", offset=d, sent=datetime(2024, 3, d, 12))
        for d in numbers
    ]
    return silver_nav(bronze(spark, sent))


def test_silver_round_trip(spark):
    root = workspace.new_folder(spark, "silver")
    nav, txn = days(spark, 1, 2), silver_txn(bronze(spark, [transaction()]))
    lake.write_silver(nav, lake.silver_path(root, NAV.folder))
    lake.write_silver(txn, lake.silver_path(root, TXN.folder))
    nav_back, txn_back = lake.read_silver(spark, root)
    assert nav_back.dtypes == [(f.name, f.dataType.simpleString()) for f in SILVER_NAV_SCHEMA]
    assert rows(nav_back.drop("processed_at")) == rows(nav)
    assert rows(txn_back.drop("processed_at")) == rows(txn)
    assert nav_back.filter("processed_at is null").count() == 0


def test_overwrite_replaces_all_days(spark):
    path = workspace.new_folder(spark, "silver")

    def stored():
        frame = spark.read.parquet(path).select("ingestion_date").distinct()
        return sorted(r[0].day for r in frame.collect())

    lake.write_silver(days(spark, 1, 2), path)
    lake.write_silver(days(spark, 5), path)
    assert stored() == [5]


def test_a_repeat_after_midnight_stays_one_row(spark):
    path = workspace.new_folder(spark, "silver")
    first = price(offset=1, sent=datetime(2024, 3, 1, 23, 59))
    again = price(offset=2, sent=datetime(2024, 3, 2, 0, 1))
    lake.write_silver(silver_nav(bronze(spark, [first])), path)
    lake.write_silver(silver_nav(bronze(spark, [again, first])), path)
    stored = spark.read.parquet(path).collect()
    assert [(r["kafka_offset"], r["ingestion_date"].day) for r in stored] == [(1, 1)]


def test_bronze_of_several_roots(spark):
    roots = [workspace.new_folder(spark, "bronze") for _ in range(2)]
    for n, root in enumerate(roots):
        bronze(spark, [price(offset=n)]).write.partitionBy(lake.DAY).parquet(root)
    offsets = [r["offset"] for r in lake.read_bronze(spark, roots).collect()]
    assert sorted(offsets) == [0, 1]


def test_one_file_per_small_day(spark):
    path = workspace.new_folder(spark, "silver")
    lake.write_silver(days(spark, *range(1, 11)).repartition(8), path)
    assert len(list(Path(path).glob("*/*.parquet"))) == 10


def test_days_are_pruned_and_columns_selected(spark):
    root = workspace.new_folder(spark, "silver")
    lake.write_silver(days(spark, 1, 2, 3), lake.silver_path(root, NAV.folder))
    lake.write_silver(silver_txn(bronze(spark, [transaction()])), lake.silver_path(root, TXN.folder))
    nav, _ = lake.read_silver(spark, root, since=date(2024, 3, 2), until=date(2024, 3, 2))
    assert [r["ingestion_date"].day for r in nav.collect()] == [2]
    plan = plan_text(nav.filter("nav > 5").groupBy("scheme_code").agg(F.max("nav")))
    scan = plan[plan.index("FileScan") :]
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan
    assert "GreaterThan(nav,5.0)" in scan
    assert "ReadSchema: struct<scheme_code:int,nav:double>" in scan


def test_empty_and_missing_tables(spark):
    path = workspace.new_folder(spark, "bronze")
    Path(path).mkdir(parents=True)
    assert lake.read_bronze(spark, path).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_bronze(spark, f"{path}/absent").count()


def test_silver_of_an_empty_table(spark):
    path, out = workspace.new_folder(spark, "bronze"), workspace.new_folder(spark, "silver")
    Path(path).mkdir(parents=True)
    counts = build_silver(lake.read_bronze(spark, path), NAV, out)
    assert set(counts.values()) == {0}


def test_audit_time_comes_last(spark):
    assert lake.with_audit(spark.range(1)).dtypes == [("id", "bigint"), ("processed_at", "timestamp")]


def test_object_store_settings():
    conf = lake.s3a_conf("store:9000", "user", "secret")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert lake.s3a_conf("s", "u", "s", ssl=True)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert len(conf) == 7 and all(name.startswith("spark.hadoop.fs.s3a.") for name in conf)


class Writer:
    """Records what a database write is asked to do."""

    def __init__(self):
        self.options, self.saved = {}, None

    def mode(self, mode):
        self.options["mode"] = mode
        return self

    def option(self, name, value):
        self.options[name] = value
        return self

    def jdbc(self, url, table, properties):
        self.saved = (url, table, properties)


class Frame:
    def __init__(self):
        self.write, self.dealt = Writer(), None

    def repartition(self, n):
        self.dealt = n
        return self


def test_database_write():
    frame = Frame()
    url = warehouse.postgres_url("db", 5432, "funds")
    props = warehouse.jdbc_properties("user", "secret")
    warehouse.write_jdbc(frame, "gold_top_funds", url, props, connections=4)
    assert frame.dealt == 4
    assert frame.write.saved == (
        "jdbc:postgresql://db:5432/funds",
        "gold_top_funds",
        {"user": "user", "password": "secret", "driver": "org.postgresql.Driver"},
    )
    assert frame.write.options == {
        "mode": "overwrite",
        "truncate": "true",
        "numPartitions": 4,
        "batchsize": 10_000,
    }


class Reader:
    """Records what a database is asked, and answers with one row."""

    def __init__(self):
        self.read, self.asked = self, None

    def jdbc(self, url, table, properties):
        self.asked = (url, table, properties)
        return self

    def first(self):
        return {"n": 7}


def test_rows_are_counted_by_the_database():
    session = Reader()
    target = warehouse.JdbcWarehouse("jdbc:x", {"user": "u"})
    assert target.count(session, "gold_top_funds") == 7
    assert session.asked == (
        "jdbc:x",
        "(SELECT count(*) AS n FROM gold_top_funds) AS counted",
        {"user": "u"},
    )


def test_secrets_stay_out_of_the_text_form():
    props = warehouse.jdbc_properties("user", "secret")
    assert "secret" not in repr(warehouse.JdbcWarehouse("jdbc:x", props))


def test_folders_follow_the_checkpoint_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.new_folder(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(f"{root}/x-")


class Session:
    def __init__(self, **conf):
        self.conf = {name.replace("_", "."): value for name, value in conf.items()}


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.new_folder(Session(spark_master="yarn"), "x")
    assert "fundflow-" in workspace.new_folder(Session(spark_master="local[2]"), "x")


def test_tables_become_visible_together(spark):
    target = warehouse.SnapshotWarehouse(workspace.new_folder(spark, "gold"))
    small, large = spark.range(1), spark.range(5)
    target.publish(spark, {"a": small, "b": small})
    failing = spark.range(3).select(F.raise_error(F.lit("no")).alias("id"))
    with pytest.raises(Exception, match="no"):
        target.publish(spark, {"a": large, "b": failing})
    assert (target.count(spark, "a"), target.count(spark, "b")) == (1, 1)
    # Who resolved the tables before a commit goes on reading them.
    held = target.read(spark, "b")
    target.publish(spark, {"b": large})
    assert (target.count(spark, "a"), target.count(spark, "b"), held.count()) == (1, 5, 1)
    target.replace("a", large)
    assert target.count(spark, "a") == 5 and target.read(spark, "a", version=1).count() == 1
    with pytest.raises(ValueError, match="no table c"):
        target.read(spark, "c")


def test_of_two_writers_one_begins_again(spark, monkeypatch):
    target = warehouse.SnapshotWarehouse(workspace.new_folder(spark, "gold"))
    target.publish(spark, {"a": spark.range(1)})
    commit = warehouse.Snapshots.commit

    def late(self, content, after):
        commit(self, {"a": "other"}, after)
        return commit(self, content, after)

    with monkeypatch.context() as patch:
        patch.setattr(warehouse.Snapshots, "commit", late)
        with pytest.raises(warehouse.Conflict):
            target.publish(spark, {"a": spark.range(2)})
    assert warehouse.Snapshots(spark, target.root).current().content == {"a": "other"}
