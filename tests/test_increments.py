from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fundflow.plans import gold_increments, increments, silver
from fundflow.plans.gold import gold_tables
from fundflow.plans.gold_increments import GoldIncrements
from fundflow.plans.increments import SilverIncrements
from fundflow.schemas import NAV, TXN
from fundflow.sources import segments
from fundflow.sources.lake import DAY, read_bronze
from fundflow.sources.snapshots import Conflict, Snapshots
from fundflow.sources.workspace import new_folder
from fundflow_checks import feeds
from fundflow.operators.envelope import to_envelope
from tests.frames import bronze, plan_text, price, rows, transaction

SMALL = "/root/testdata/sf0.001"


def land(frame, path):
    frame.write.partitionBy(DAY).parquet(path, mode="append")


def counts(report):
    return {r["rule"]: r["rows"] for r in report.collect()}


def full(spark, path, feed):
    landed = read_bronze(spark, path)
    make, judge = (
        (silver.silver_nav, silver.nav_quality) if feed is NAV else (silver.silver_txn, silver.txn_quality)
    )
    return make(landed), counts(judge(landed))


def same(spark, table, path):
    want, report = full(spark, path, table.feed)
    assert rows(table.read().drop("processed_at")) == rows(want)
    assert counts(table.quality()) == report


def slices(spark, feed, n):
    """The feed in so many parts, repeats often before what they repeat."""
    records = feeds.nav_records if feed is NAV else feeds.txn_records
    whole = to_envelope(records(feeds.table(spark, SMALL, "events")))
    part = F.pmod(F.hash("offset"), F.lit(n))
    return [whole.filter(part == k) for k in range(n)]


@pytest.mark.parametrize("feed", [NAV, TXN], ids=["nav", "txn"])
def test_increments_equal_a_full_run(spark, feed, monkeypatch):
    monkeypatch.setattr(increments, "MOST_SEGMENTS", 2)
    path = new_folder(spark, "bronze")
    table = SilverIncrements(spark, feed, new_folder(spark, "silver"), buckets=4)
    for part in slices(spark, feed, 4):
        land(part, path)
        table.advance(path)
        same(spark, table, path)
    state = table.versions.current().content
    assert len(state["index"]) <= 2 + 1 and max(map(len, state["live"].values())) <= 3


def test_only_new_files_are_read(spark):
    path = new_folder(spark, "bronze")
    table = SilverIncrements(spark, NAV, new_folder(spark, "silver"), buckets=2)
    seen = []
    merge = table.merge
    table.merge = lambda batch, *rest: (seen.append(batch.count()), merge(batch, *rest))
    for n in range(3):
        land(bronze(spark, [price(offset=10 * n + k, fund=k) for k in range(n + 1)]), path)
        table.advance(path)
    table.advance(path)
    assert [n for n in seen if n] == [1, 2, 3]
    same(spark, table, path)


def test_a_message_that_comes_late_takes_its_key(spark):
    path = new_folder(spark, "bronze")
    table = SilverIncrements(spark, NAV, new_folder(spark, "silver"), buckets=2)
    first, second = datetime(2024, 3, 1, 23, 59), datetime(2024, 3, 2, 0, 1)
    batches = [
        # The only row of its day, which a lower offset of the day before takes over.
        [price(7.0, offset=9, sent=second)],
        [price(8.0, offset=4, sent=first), price(8.0, offset=5, fund=2, sent=first)],
        # Lower yet, and breaking a rule: the key has no row any more.
        [price(-1.0, offset=3, sent=first)],
        # A repeat after midnight loses, a bad one too, and one without a price is no key.
        [price(9.0, offset=11, sent=second), price(-2.0, fund=2, offset=12), price(None, offset=1)],
        # A lower partition wins whatever the offset.
        [price(5.0, partition=0, offset=2, sent=second)],
    ]
    for sent in batches:
        land(bronze(spark, sent), path)
        table.advance(path)
        same(spark, table, path)
    assert [r["nav"] for r in table.read().orderBy("scheme_code").collect()] == [5.0, 8.0]


def test_a_repeated_batch_is_merged_once(spark):
    table = SilverIncrements(spark, TXN, new_folder(spark, "silver"), buckets=2)
    batch = bronze(spark, [transaction("A"), transaction("A", offset=1), transaction("B", amount=-1.0, offset=2)])
    table.merge(batch, "s", 0)
    before = table.versions.current().number
    table.merge(batch, "s", 0)
    assert table.versions.current().number == before
    assert counts(table.quality()) == {
        "read": 3, "required": 0, "duplicate": 1, "not_positive": 1, "bad_domain": 0, "kept": 1,
    }
    # The same messages from another source are repeats, all of them.
    table.merge(batch, "t", 0)
    assert counts(table.quality())["duplicate"] == 4 and table.read().count() == 1


def test_a_batch_that_fails_leaves_the_table_as_it_was(spark, monkeypatch):
    table = SilverIncrements(spark, NAV, new_folder(spark, "silver"), buckets=2)
    table.merge(bronze(spark, [price()]), "s", 0)
    broken = bronze(spark, [price(2.0, fund=2, offset=1)])
    with monkeypatch.context() as patch:
        patch.setattr(Snapshots, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.merge(broken, "s", 1)
    assert table.read().count() == 1
    table.merge(broken, "s", 1)
    assert table.read().count() == 2 and counts(table.quality())["kept"] == 2


def test_empty_tables(spark):
    table = SilverIncrements(spark, NAV, new_folder(spark, "silver"))
    assert table.read().count() == 0 and table.quality().count() == 0
    table.merge(bronze(spark, []), "s", 0)
    assert table.read().count() == 0 and set(counts(table.quality()).values()) == {0}


def test_known_keys_are_not_shuffled(spark):
    table = SilverIncrements(spark, TXN, new_folder(spark, "silver"), buckets=4)
    table.merge(bronze(spark, [transaction(str(k), offset=k) for k in range(50)]), "s", 0)
    index = increments.KeyIndex(spark, table._entry, TXN.key, increments.MESSAGE_ORDER, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with index.opened(table.versions.current().content["index"]) as [known]:
            keys = spark.range(9).selectExpr("cast(id as string) as transaction_id")
            plan = plan_text(known.join(keys, "transaction_id"))
            # One shuffle, of the new keys; the index is read where it lies.
            assert plan.count("Exchange hashpartitioning") == 1
            assert "Bucketed: true" in plan
            assert index.holders([known], keys).count() == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_first_batch_is_joined_with_nothing(spark):
    table = SilverIncrements(spark, TXN, new_folder(spark, "silver"), buckets=4)
    index = increments.KeyIndex(spark, table._entry, TXN.key, increments.MESSAGE_ORDER, 4)
    fresh = increments.judge(increments.typed_rows(bronze(spark, [transaction("1")]), TXN), TXN)
    decided = table._decide(fresh, index, [])
    assert "Join" not in plan_text(decided)
    assert [(r["wins"], r["known"], r["old_rule"]) for r in decided.collect()] == [(True, False, None)]


def gold_of(spark, root):
    made = {feed.name: SilverIncrements(spark, feed, f"{root}/{feed.name}", 2) for feed in (NAV, TXN)}
    return made, GoldIncrements(spark, f"{root}/gold", made["nav"], made["txn"])


def test_merged_gold_equals_gold_from_scratch(spark, monkeypatch):
    monkeypatch.setattr(increments, "MOST_SEGMENTS", 2)
    root = new_folder(spark, "lake")
    made, gold = gold_of(spark, root)
    for parts in zip(*(slices(spark, feed, 3) for feed in (NAV, TXN))):
        for part, table in zip(parts, made.values()):
            land(part, f"{root}/bronze/{table.feed.name}")
            table.advance(f"{root}/bronze/{table.feed.name}")
        gold.advance()
        want = gold_tables(*(table.read().drop("processed_at") for table in made.values()))
        for name, frame in want.items():
            assert rows(gold.read(name).drop("processed_at")) == rows(frame), name


def test_days_are_published_once_for_all_tables(spark):
    made, gold = gold_of(spark, new_folder(spark, "lake"))
    made["nav"].merge(bronze(spark, [price(offset=1)]), "s", 0)
    made["txn"].merge(bronze(spark, [transaction("1")]), "s", 0)
    tables = gold._tables(gold.advance().content["states"])
    for name in ("gold_nav_performance", "gold_top_funds"):
        assert not [f for f in tables[name].inputFiles() if "/states/" in f], name


def test_unchanged_days_are_not_reduced_again(spark, monkeypatch):
    made, gold = gold_of(spark, new_folder(spark, "lake"))
    sent = [price(offset=d, sent=datetime(2024, 3, d, 12)) for d in (1, 2)]
    made["nav"].merge(bronze(spark, [sent[0], price(3.0, fund=3, offset=7, sent=datetime(2024, 3, 3))]), "s", 0)
    made["txn"].merge(bronze(spark, [transaction()]), "s", 0)
    gold.advance()
    before = gold.versions.current().content["states"]["nav"]
    made["nav"].merge(bronze(spark, [price(11.0, at="2024-03-03 09:00:00", fund=3, offset=8, sent=datetime(2024, 3, 3))]), "s", 1)
    seen = []
    reduce = gold_increments.REDUCTIONS[0].reduce
    spy = gold_increments.Reduction(NAV, lambda f: (seen.append(f.count()), reduce(f))[1], gold_increments.merge_fund_days)
    monkeypatch.setattr(gold_increments, "REDUCTIONS", (spy, gold_increments.REDUCTIONS[1]))
    gold.advance()
    after = gold.versions.current().content["states"]["nav"]
    assert before["2024-03-01"] == after["2024-03-01"] and before["2024-03-03"] != after["2024-03-03"]
    assert max(seen) == 1
    assert gold.read("gold_nav_performance").filter("scheme_code = 3").first()["nav_updates"] == 2


def test_states_of_another_layout_are_made_anew(spark, monkeypatch):
    made, gold = gold_of(spark, new_folder(spark, "lake"))
    made["nav"].merge(bronze(spark, [price()]), "s", 0)
    made["txn"].merge(bronze(spark, [transaction()]), "s", 0)
    gold.advance()
    before = gold.versions.current().content
    monkeypatch.setattr(gold_increments, "STATE_SCHEMA", 2)
    gold.advance()
    after = gold.versions.current().content
    assert after["schema"] == 2
    assert before["states"]["nav"] != after["states"]["nav"]
    assert rows(gold.read("gold_top_funds").drop("processed_at")) != []


def test_a_run_that_fails_leaves_all_tables(spark, monkeypatch):
    made, gold = gold_of(spark, new_folder(spark, "lake"))
    made["nav"].merge(bronze(spark, [price()]), "s", 0)
    made["txn"].merge(bronze(spark, [transaction()]), "s", 0)
    gold.advance()
    made["txn"].merge(bronze(spark, [transaction("B", amount=9.0, offset=5)]), "s", 1)
    tables = gold._tables
    raising = F.raise_error(F.lit("table four")).cast("double")
    monkeypatch.setattr(
        gold, "_tables", lambda s: tables(s) | {"gold_top_funds": spark.range(1).select(raising.alias("x"))}
    )
    with pytest.raises(Exception, match="table four"):
        gold.advance()
    assert gold.read("gold_txn_volume").first()["txn_count"] == 1
    monkeypatch.setattr(gold, "_tables", tables)
    gold.advance()
    assert gold.read("gold_txn_volume").first()["txn_count"] == 2


def test_changes_between_versions():
    before = {"a": ["1"], "b": ["1", "2"], "c": ["1"], "d": ["4"]}
    after = {"a": ["1", "5"], "b": ["5"], "d": ["4"], "e": ["5", "6"]}
    assert segments.changed_days(before, after) == ({"a": ["5"], "e": ["5", "6"]}, {"b": ["5"]}, ["c"])


def test_versions(spark):
    versions = Snapshots(spark, new_folder(spark, "versions"))
    first = versions.current()
    assert (first.number, first.content) == (0, {})
    one = versions.commit({"a": [1], "ü": None}, first)
    assert versions.current() == one
    with pytest.raises(Conflict):
        versions.commit({"a": [2]}, first)
    assert versions.current().content == {"a": [1], "ü": None}
    named, lost = versions.folder("x"), versions.folder("y")
    for folder in (named, lost):
        spark.range(1).write.parquet(folder)
    versions.commit({"x": named}, versions.current())
    assert versions.clean(keep=1) == [] and versions.numbers() == [2]
    assert versions.clean(keep=1, older_than=-60) == [lost.rpartition("/")[2]]
    assert spark.read.parquet(named).count() == 1
