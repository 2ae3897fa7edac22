from __future__ import annotations

import importlib
import re
import sys
from pathlib import Path

import pytest

from fundflow_checks import compare
from fundflow_checks.oracle import oracle_sql
from fundflow_checks.queries import REGISTRY
from tests.frames import plan_text

SMALL = "/root/testdata/sf0.001"
HOME = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def small():
    return compare.connect(SMALL)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, small, name):
    assert compare.difference(REGISTRY[name](spark, SMALL), small, oracle_sql()[name]) is None


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())
    frame = entry.entry(spark)
    assert frame.columns[-1] == "rank" and frame.count() > 0


def test_entry_works_without_the_training_part(monkeypatch):
    gone = ("fundflow.llm", "corpus_pipeline", "__spark_entry__")
    for name in [m for m in sys.modules if m.startswith(gone)]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "fundflow.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    try:
        assert set(entry.queries()) == set(REGISTRY) == set(entry.oracle_sql())
    finally:
        sys.modules.pop("__spark_entry__")


@pytest.mark.parametrize("name", ["silver_nav", "silver_txn", "silver_nav_not_null"])
def test_messages_are_parsed_once(spark, name):
    assert plan_text(REGISTRY[name](spark, SMALL)).count("from_json(") == 1


LAZY = [name for name in REGISTRY if not name.startswith(("bronze_stream", "layers", "increments"))]


@pytest.mark.parametrize("name", sorted(LAZY))
def test_plans_hold_at_scale(spark, name):
    plan = plan_text(REGISTRY[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEval"):
        assert operator not in plan
    # One partition only for totals and for the bounded list of rank bands.
    for single in re.finditer(r"Exchange SinglePartition[^\n]*\n[^\n]*\n?", plan):
        assert re.search(r"partial_|HashAggregate\(keys=\[(band|_groupingexpression)", single.group())


def test_library_has_no_sessions_prints_or_collects():
    for path in (HOME / "fundflow").rglob("*.py"):
        if "llm" in path.parts:
            continue  # a part of its own, with tests of its own
        text = path.read_text()
        for word in ("builder", "print(", ".collect(", ".toPandas(", "localCheckpoint", ".rdd"):
            assert word not in text, f"{word} in {path}"
