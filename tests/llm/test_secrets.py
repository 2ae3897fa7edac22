from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from fundflow.llm import secrets

SCHEMA = "doc_id long, text string, source string, row int, score string"


def hexes(rng, n=40):
    return "".join(rng.choices("0123456789abcdef", k=n))


def corpus(rng):
    words = ["alpha", "bravo", "charlie", "delta", "commit", "build", "report"]
    rows, truth = [], {}
    for k in range(240):
        prose = " ".join(rng.choices(words, k=30))
        value = hexes(rng)
        if k % 3 == 0:
            rows.append((k, f'{prose} api_key = "{value}" {prose}', "src/app.py"))
        elif k % 3 == 1:
            rows.append((k, f"{prose} commit {value} {prose}", "docs/changes.md"))
        else:
            rows.append((k, f"{prose} AlphaBravoCharlieDelta{rng.randrange(99)} {prose}", "src/app.py"))
        truth[k] = int(k % 3 == 0)
    return rows, truth


def test_forest_removes_false_positives_of_held_out_findings(spark):
    rows, truth = corpus(random.Random(6))
    frame = spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA).repartition(4)
    found = secrets.described(secrets.candidates(frame), secrets.Corpus.learn(frame))
    label = (F.col("id") % 3 == 0).cast("int")
    train = found.withColumn("label", F.when(F.col("id") % 2 == 0, label))
    scanner = secrets.Scanner.train(train, max_rows=500)
    scored = scanner.score(found)
    got = {r["id"]: r["score"] for r in scored.select("id", "score").collect()}
    assert set(got) == set(truth)
    assert all((got[k] >= 0.5) == bool(truth[k]) for k in truth if k % 2)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_candidates_and_edges(spark):
    long = "word " * 60_000 + "token=" + "a1" * 12
    rows = [
        (1, None, "p"), (2, "", "p"), (3, "short a1b2c3", "p"), (4, "onlylettersbutverylong", "p"),
        (5, "k='" + "A9" * 10 + "'&z='" + "b8" * 9 + "'", None), (5, "x " + "c7" * 9, "p"),
        (5, "x " + "c7" * 9, "p"), (None, "d6" * 9, "p"), (6, long, "p"),
    ]
    frame = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    found = secrets.candidates(frame).collect()
    assert sorted((r["id"] or 0, r["part"], len(r["candidate"])) for r in found) == [
        (0, 0, 18), (5, 0, 18), (5, 0, 18), (5, 0, 20), (5, 1, 18), (6, 0, 24),
    ]
    described = secrets.described(secrets.candidates(frame), secrets.Corpus.learn(frame))
    nobody = secrets.Scanner.train(described.withColumn("label", F.lit(None).cast("int")))
    assert {r["score"] for r in nobody.score(described).collect()} == {0.0}
    empty = spark.createDataFrame([], SCHEMA)
    none = secrets.described(secrets.candidates(empty), secrets.Corpus.learn(empty))
    assert nobody.score(none).count() == 0


def test_dictionary_keeps_rare_words_of_a_large_corpus(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + "q" for a in letters for b in letters for c in letters]
    words += [w + "r" for w in words]
    text = " ".join(words * 2) + " " + " ".join(words[:30_000])
    rare = words[-1]
    frame = spark.createDataFrame(
        [(1, text, "p", 0, ""), (2, f"{rare}/{rare}/{rare}/9 onceonly", "p", 0, "")], SCHEMA
    )
    corpus = secrets.Corpus.learn(frame)
    kept = corpus.dictionary.collect()
    assert {r["fragment"] for r in kept} == set(words) and len(kept) == len(words)
    (found,) = secrets.described(secrets.candidates(frame), corpus).collect()
    assert found["coverage"] == 15 / 19


def test_few_secrets_among_many_labelled_candidates_are_learned(spark):
    rng = random.Random(9)
    rows = [
        (k, f'config api_key = "{hexes(rng)}" end' if k % 300 == 0 else f"see commit {hexes(rng)} end",
         "src/app.py", 0, "")
        for k in range(3_000)
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = secrets.described(secrets.candidates(frame), secrets.Corpus.learn(frame))
    labelled = found.withColumn("label", (F.col("id") % 300 == 0).cast("int"))
    weights = secrets._sampled(labelled, 40).groupBy("label").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w")
    )
    assert {(r["label"], r["n"], r["w"]) for r in weights.collect()} == {(0, 20, 2990), (1, 10, 10)}
    scored = secrets.Scanner.train(labelled, max_rows=40).score(found)
    got = {r["id"] for r in scored.filter("score >= 0.5").collect()}
    assert got == set(range(0, 3_000, 300))


def test_assigned_values_of_any_characters_are_candidates(spark):
    rows = [
        (1, 'password = "Tr0ub4dor&3"'), (2, "x pwd='s3cr3t!2024' y"), (3, "db://user:p!ss99@host/x"),
        (4, '{"api_key": "ab-cd.ef!"},'), (5, "password: hunter2;"), (6, "password = short"),
        (7, "the keyboard: letters"), (8, "passwd='onlylowercaseletters'"), (9, 'token = "' + "a1" * 12 + '"'),
        (10, "a = secretive word"), (11, "secret: first-1 other words"),
        (12, "password = password"), (13, "pwd = 'ab(cd);)'"), (14, "pwd=aa11bb pwd=aa11bb"),
    ]
    frame = spark.createDataFrame([(k, t, "p", 0, "") for k, t in rows], SCHEMA)
    found = secrets.candidates(frame)
    assert sorted((r["id"], r["candidate"]) for r in found.collect()) == [
        (1, "Tr0ub4dor&3"), (2, "s3cr3t!2024"), (3, "p!ss99"), (4, "ab-cd.ef!"), (5, "hunter2"),
        (8, "onlylowercaseletters"), (9, "a1" * 12), (11, "first-1"),
        (12, "password"), (13, "ab(cd);)"), (14, "aa11bb"), (14, "aa11bb"),
    ]
    described = secrets.described(found, secrets.Corpus.learn(frame))
    labels = {r["id"]: r["label"] for r in secrets.rule_labels(described).collect()}
    assert labels[1] == labels[2] == labels[9] == 1 and labels[3] is None


def test_mixed_words(spark):
    """As two alternatives with letters in between, tried from every place."""
    rng = random.Random(3)
    words = ["".join(rng.choices("aZ-", k=rng.randrange(9))) for _ in range(400)] + ["a1", "", "aB", "Ba", "aaB", "AbC"]
    rule = re.compile("[0-9]|[A-Za-z].*[a-z].*[A-Z]|[A-Za-z].*[A-Z].*[a-z]")
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"]: r["m"] for r in frame.select("w", secrets._mixed(F.col("w")).alias("m")).collect()}
    assert got == {w: bool(rule.search(w)) for w in words}


@pytest.mark.parametrize("unit", ["g", "G", "gG", "漢", "acgt", "-", "4"])
def test_one_long_word_does_not_hold_up_a_task(spark, unit):
    started = time.monotonic()
    text = unit * (1_000_000 // len(unit))
    frame = spark.createDataFrame([(1, text, "s", 1, "s")], SCHEMA)
    assert secrets.candidates(frame).count() in (0, 1)
    assert time.monotonic() - started < 20
