from __future__ import annotations

from datetime import date

from fundflow.operators.drift import message_fields, schema_drift
from fundflow.schemas import NAV, TXN
from fundflow_checks import feeds
from tests.frames import plan_text

DAY = date(2024, 3, 1)


def sent(spark, *payloads):
    return spark.createDataFrame([(DAY, p) for p in payloads], "ingestion_date date, json_payload string")


def found(frame):
    return {(r["field"], r["kind"]): (r["messages"], r["verdict"]) for r in frame.collect()}


def test_each_field_gets_a_verdict(spark):
    got = found(schema_drift(sent(
        spark,
        '{"timestamp":"a","scheme_code":5,"scheme_name":"n","nav":1.50,"extra":{"a":1},"b":null}',
        '{"timestamp":null,"scheme_code":5.0,"scheme_name":["n"],"nav":1e5,"a.b":true}',
        '{"nav":7,"scheme_code":"5"}', "{}", "not json", "[1]", "3", "null", None, "",
    ), NAV))
    assert got == {
        ("timestamp", "string"): (1, "expected"),
        ("timestamp", "null"): (1, "empty"),
        ("timestamp", "missing"): (2, "missing"),
        ("scheme_code", "integer"): (1, "expected"),
        ("scheme_code", "number"): (1, "other kind"),
        ("scheme_code", "string"): (1, "other kind"),
        ("scheme_code", "missing"): (1, "missing"),
        ("scheme_name", "string"): (1, "expected"),
        ("scheme_name", "array"): (1, "other kind"),
        ("scheme_name", "missing"): (2, "missing"),
        ("nav", "number"): (2, "expected"),
        ("nav", "integer"): (1, "expected"),
        ("nav", "missing"): (1, "missing"),
        ("extra", "object"): (1, "unknown"),
        ("b", "null"): (1, "unknown"),
        ("a.b", "boolean"): (1, "unknown"),
        (None, "unreadable"): (3, "unreadable"),
        (None, "no object"): (3, "unreadable"),
    }


def test_numbers_of_any_size_are_numbers(spark):
    got = found(schema_drift(sent(
        spark, '{"nav":123456789012345678901234567890}', '{"nav":-0.5}', '{"nav":1E-300}', '{"nav":9223372036854775807}',
    ), NAV))
    assert sum(n for (field, kind), (n, v) in got.items() if field == "nav" and v == "expected") == 4


def test_no_messages(spark):
    assert schema_drift(sent(spark), TXN).count() == 0
    assert message_fields(sent(spark)).count() == 0


def test_messages_are_parsed_once(spark):
    plan = plan_text(schema_drift(feeds.nav_bronze(spark, "/root/testdata/sf0.001"), NAV))
    assert plan.count("FileScan") == 1 and plan.count("Generate explode") == 2 + 1  # repeats of the feed


def test_the_type_of_a_value_is_found_once(spark):
    """Once for all kinds, and not for a whole message, whose type lists every field."""
    plan = plan_text(message_fields(sent(spark, '{"nav":1.5}')))
    assert plan.lower().replace("_", "").count("schemaofvariant(") == 1
