from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fundflow_checks import feeds, stepwise
from fundflow.plans import silver
from fundflow.operators.envelope import to_envelope
from fundflow.operators.payload import flatten_nav, flatten_txn, parse_payload
from fundflow.schemas import BRONZE_SCHEMA, KAFKA_SCHEMA, NAV, NAV_SCHEMA, NAV_TOPIC, TXN, TXN_SCHEMA
from fundflow.sources.workspace import new_folder
from tests.frames import bronze, message, plan_text, price, rows, transaction

SMALL = "/root/testdata/sf0.001"


def shape(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema]


def test_envelope_takes_text_and_the_day_of_the_record(spark):
    sent = datetime(2024, 3, 2, 0, 0, 1)
    record = (bytearray(b"k"), bytearray("ü".encode()), "t", 3, 9, sent)
    envelope = to_envelope(spark.createDataFrame([record], KAFKA_SCHEMA))
    assert tuple(envelope.first()) == ("k", "ü", "t", 3, 9, sent, date(2024, 3, 2))
    assert shape(envelope.schema) == shape(BRONZE_SCHEMA)


NULLS = (None, None, None, None)
JSON_OUTCOMES = [
    (
        '{"timestamp":"t","scheme_code":1,"scheme_name":"a","nav":2.5}',
        ("t", 1, "a", 2.5),
    ),
    ("not json", NULLS),
    ('{"nav":2.5', NULLS),
    ('[1, 2]', NULLS),
    ("", None),
    (None, None),
    ("{}", NULLS),
    ('{"NAV":2.5}', NULLS),
    ('{"scheme_code":"1","nav":2.5}', (None, None, None, 2.5)),
    ('{"scheme_code":1.0,"nav":2.5}', (None, None, None, 2.5)),
    ('{"scheme_code":9999999999,"nav":2.5}', (None, None, None, 2.5)),
    ('{"nav":"2.5","scheme_code":1}', (None, 1, None, None)),
    ('{"nav":2}', (None, None, None, 2.0)),
    ('{"scheme_name":5}', (None, None, "5", None)),
    ('{"scheme_code":1,"nav":NaN}', NULLS),
    ('{"nav":"NaN","scheme_code":1}', (None, 1, None, None)),
    ('{"scheme_code":1,"nav":Infinity}', NULLS),
    ('{"nav":"-Infinity","scheme_code":1}', (None, 1, None, None)),
    ('{"nav":1e999}', (None, None, None, float("inf"))),
    ('{"nav":2.5,"other":1}', (None, None, None, 2.5)),
    ('{"nav":2.5} tail', (None, None, None, 2.5)),
]


@pytest.mark.parametrize("filtered", [False, True])
def test_json_outcomes(spark, filtered):
    sent = [message(text, NAV_TOPIC, offset=i) for i, (text, _) in enumerate(JSON_OUTCOMES)]
    parsed = parse_payload(bronze(spark, sent), NAV_SCHEMA, filtered).orderBy("offset")
    got = [None if r["parsed"] is None else tuple(r["parsed"]) for r in parsed.collect()]
    assert got == [want for _, want in JSON_OUTCOMES]


def test_times(spark):
    texts = ["2026-06-21 10:00:00", "2026-06-21T10:00:00Z", "2026-06-21", "garbage", None]
    sent = [price(at=text, offset=i) for i, text in enumerate(texts)]
    typed = silver.typed_rows(bronze(spark, sent), NAV).orderBy("kafka_offset")
    got = [r["event_timestamp"] for r in typed.collect()]
    ten = datetime(2026, 6, 21, 10)
    assert got == [ten, ten, datetime(2026, 6, 21), None, None]


def test_silver_columns_and_types(spark):
    for feed, table, flat in (
        (NAV, silver.silver_nav, flatten_nav),
        (TXN, silver.silver_txn, flatten_txn),
    ):
        frame = bronze(spark, [price(), transaction()])
        assert shape(table(frame).schema) == shape(feed.silver)[:-1]
        payload = NAV_SCHEMA if feed is NAV else TXN_SCHEMA
        typed = flat(parse_payload(frame, payload))
        assert typed.columns == [*feed.silver_columns, "kafka_partition"]


def test_lowest_partition_and_offset_wins(spark):
    sent = [
        price(nav=3.0, partition=1, offset=0),
        price(nav=2.0, partition=0, offset=8),
        price(nav=1.0, partition=0, offset=7),
    ]
    for n in (1, 3):
        kept = silver.silver_nav(bronze(spark, sent).repartition(n)).collect()
        assert [(r["nav"], r["kafka_offset"]) for r in kept] == [(1.0, 7)]


def test_a_bad_first_row_takes_its_key_along(spark):
    sent = [price(nav=-1.0, offset=0), price(nav=5.0, offset=1)]
    assert silver.silver_nav(bronze(spark, sent)).count() == 0
    sent = [transaction(kind="SWITCH", offset=0), transaction(kind="BUY", offset=1)]
    assert silver.silver_txn(bronze(spark, sent)).count() == 0


def test_an_incomplete_first_row_does_not(spark):
    sent = [price(nav=None, offset=0), price(nav=5.0, offset=1)]
    assert [r["nav"] for r in silver.silver_nav(bronze(spark, sent)).collect()] == [5.0]


def test_a_repeat_after_midnight_keeps_the_first_day(spark):
    early, late = datetime(2024, 3, 1, 23, 59, 59), datetime(2024, 3, 2, 0, 0, 1)
    sent = [transaction(offset=1, sent=late), transaction(offset=0, sent=early)]
    kept = silver.silver_txn(bronze(spark, sent)).collect()
    assert [r["ingestion_date"] for r in kept] == [date(2024, 3, 1)]


@pytest.mark.parametrize("others", [[], [transaction(id="T9", kind="SWITCH", offset=9)]])
def test_a_missing_type_is_dropped_whatever_the_other_rows(spark, others):
    sent = [transaction(id="T1", kind=None, offset=1), transaction(id="T2", offset=2), *others]
    frame = bronze(spark, sent)
    assert [r["transaction_id"] for r in silver.silver_txn(frame).collect()] == ["T2"]
    report = {r["rule"]: r["rows"] for r in silver.txn_quality(frame).collect()}
    assert report["bad_domain"] == 1 + len(others)


def test_prices_must_be_finite(spark):
    sent = [message('{"timestamp":"2024-03-01","scheme_code":1,"nav":1e999}', NAV_TOPIC)]
    assert silver.silver_nav(bronze(spark, sent)).count() == 0
    report = {r["rule"]: r["rows"] for r in silver.nav_quality(bronze(spark, sent)).collect()}
    assert report["not_positive"] == 1


def test_status_is_not_judged(spark):
    sent = transaction()[1].decode().replace("SUCCESS", "FAILED")
    frame = bronze(spark, [message(sent, TXN.topic)])
    assert [r["status"] for r in silver.silver_txn(frame).collect()] == ["FAILED"]


def test_report_lists_every_rule_on_no_messages(spark):
    report = silver.txn_quality(bronze(spark, [])).collect()
    assert [(r["feed"], r["rule"], r["rows"]) for r in report] == [
        ("txn", rule, 0)
        for rule in ("read", "required", "duplicate", "not_positive", "bad_domain", "kept")
    ]


@pytest.mark.parametrize("feed", [NAV, TXN], ids=["nav", "txn"])
def test_one_pass_equals_step_by_step(spark, feed):
    """Counts and rows against one action per step; the bad-type rule always applied."""
    frame = feeds.nav_bronze(spark, SMALL) if feed is NAV else feeds.txn_bronze(spark, SMALL)
    path, steps_path = new_folder(spark, "one"), new_folder(spark, "steps")
    counts = silver.build_silver(frame, feed, path)
    # With rows in message order dropDuplicates keeps the first one of a key.
    typed = silver.typed_rows(frame.coalesce(1).sortWithinPartitions("offset"), feed)
    steps = stepwise.silver_steps(typed.coalesce(1), feed, steps_path)
    assert counts["read"] == steps["step_read"]
    assert counts["read"] - counts["required"] == steps["step_complete"]
    assert (
        counts["read"] - counts["required"] - counts["duplicate"] == steps["step_distinct"]
    )
    assert steps["step_distinct"] - counts["not_positive"] == steps["step_positive"]
    if feed is TXN:
        assert steps["step_positive"] - counts["bad_domain"] == steps["step_kept"]
    assert counts["read"] == sum(n for rule, n in counts.items() if rule != "read")
    quality = silver.nav_quality if feed is NAV else silver.txn_quality
    assert {r["rule"]: r["rows"] for r in quality(frame).collect()} == counts
    written = spark.read.parquet(path)
    assert written.count() == counts["kept"]
    keys = [*feed.key, feed.measure]
    assert rows(written.select(*keys)) == rows(spark.read.parquet(steps_path).select(*keys))


def test_result_does_not_depend_on_partitioning(spark):
    frame = feeds.txn_bronze(spark, SMALL)
    want = rows(silver.silver_txn(frame))
    for n in (1, 4, 16):
        shuffled = frame.repartition(n, F.hash("json_payload", F.lit(n)))
        assert rows(silver.silver_txn(shuffled)) == want


def test_a_key_with_a_third_of_all_messages(spark):
    """The hot key leaves each map task as one row."""
    n = 30_000
    sent = spark.range(n).selectExpr(
        "cast(null as string) as key",
        """to_json(named_struct('transaction_id', if(id % 3 = 0, 'HOT', 'T' || id),
             'timestamp', '2024-03-01 10:00:00', 'scheme_code', 1, 'transaction_type', 'BUY',
             'amount', cast(id + 1 as double), 'status', 'SUCCESS')) as json_payload""",
        "'txn_raw' as topic", "0 as partition", "id as offset",
        "timestamp'2024-03-01 12:00:00' as timestamp", "date'2024-03-01' as ingestion_date",
    ).repartition(6)
    judged = silver.judged_rows(sent, TXN)
    report = {r["rule"]: r["rows"] for r in silver.txn_quality(sent).collect()}
    assert report["duplicate"] == n // 3 - 1
    hot = judged.filter("transaction_id = 'HOT'").collect()
    assert [(r["amount"], r["messages"]) for r in hot] == [(1.0, n // 3)]
    plan = plan_text(judged)
    exchange = plan.index("Exchange hashpartitioning")
    assert "partial_min(struct(" in plan[exchange:], "rows of a key are reduced before the shuffle"
