from __future__ import annotations

import uuid

from fundflow.llm.exact_dedup import DigestIndex
from fundflow.sources.workspace import new_folder

SCHEMA = "doc_id long, text string, digest string, row long, keep_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "d", 1, 2) for i, t in rows], SCHEMA)


def index(spark):
    name = f"test_{uuid.uuid4().hex}"
    return DigestIndex(spark, name, new_folder(spark, "index"), buckets=4).open()


ROWS = [
    (1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, "a\xa0b"), (5, None), (6, ""), (7, " \r\x0b"),
    (None, "ab   "), (8, "x"), (8, "x"), (9, "y" * 300_000), (10, "y" * 300_000 + " "),
]


def test_the_longest_then_the_smallest_id_stays(spark):
    got = index(spark).decisions(frame(spark, ROWS).repartition(3)).collect()
    assert len(got) == len(ROWS)
    by = {r["id"]: r for r in got}
    # "ab   " is longest but has no id; a longer text comes before an id.
    assert by[1]["keep_id"] is None and by[1]["group_size"] == 4
    assert [r["kept"] for r in got if r["keep_id"] is None] .count(True) == 1
    assert by[4]["keep_id"] == 4
    assert {by[k]["keep_id"] for k in (5, 6, 7)} == {7}
    assert sorted(r["kept"] for r in got if r["id"] == 8) == [False, True]
    assert by[9]["keep_id"] == 10 and not by[9]["kept"]
    assert all(len(r["text_sha256"]) == 64 for r in got)


def test_later_batches_are_measured_against_the_index(spark):
    kept = index(spark)
    assert kept.decisions(frame(spark, [(1, "a"), (2, "b")])).filter("kept").count() == 2
    again = {r["id"]: r for r in kept.decisions(frame(spark, [(3, "a"), (4, "c")])).collect()}
    assert (again[3]["kept"], again[3]["keep_id"]) == (False, 1)
    assert (again[4]["kept"], again[4]["keep_id"]) == (True, 4)
    # The same folder opened anew, as a later session does.
    other = DigestIndex(spark, f"{kept.name}_again", kept.path, buckets=4).open()
    assert other.read().count() == 3
    rest = other.drop_copies(frame(spark, [(5, "b"), (6, "d"), (7, "d ")]))
    assert [r["doc_id"] for r in rest.collect()] == [7]
    assert rest.columns == frame(spark, []).columns


def test_the_index_is_not_shuffled(spark):
    kept = index(spark)
    kept.append(frame(spark, []).selectExpr("binary(text) digest", "doc_id keep_id", "1 n_chars"))
    best = frame(spark, [(1, "a")]).selectExpr("binary(text) digest", "doc_id")
    plan = kept._unknown(best, "digest")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


def test_empty_table(spark):
    assert index(spark).decisions(frame(spark, [])).count() == 0
    assert index(spark).drop_copies(frame(spark, [])).count() == 0
