from __future__ import annotations

import random
from itertools import product

import numpy as np

from fundflow.llm import language
from fundflow.llm.language import Model

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"
STEMS = {"aa": "abdegnra", "bb": "ioustlcm", "gr": "αβγδεζηθ"}


def text(lang, n, rng):
    return " ".join("".join(rng.choices(STEMS[lang], k=rng.randrange(2, 9))) for _ in range(n))


def test_labels_equal_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    model = Model(["x", "y", "z"], penalty=1.3)
    for _ in range(40):
        sizes = rng.integers(1, 6, 3)
        words = language.words_in([" ".join(["w"] * n) for n in sizes])
        scores = rng.normal(size=(len(words.first), 3))
        model.word_scores = lambda _, s=scores: s
        labels = model.label(words)
        at = 0
        for n in sizes:
            part = scores[at : at + n]
            value = lambda p, part=part: (
                sum(part[k, q] for k, q in enumerate(p))
                - 1.3 * sum(a != b for a, b in zip(p, p[1:]))
            )
            best = max(value(p) for p in product(range(3), repeat=int(n)))
            assert abs(value(labels[at : at + n].tolist()) - best) < 1e-9
            at += n


def test_words_and_scripts():
    words = language.words_in(["Ab, c1d", None, "", "é日本"])
    assert words.text.tolist() == [0, 0, 0, 3]
    assert words.length.tolist() == [2, 1, 1, 3]
    assert language.scripts_of(np.array([ord(c) for c in "aéαж日한カ1"])).tolist() == [
        1, 1, 2, 3, 14, 12, 13, 0,
    ]


def test_model_on_held_out_and_mixed_texts(spark):
    rng = random.Random(4)
    rows = [(k, text(lang, 30, rng), lang) for k in range(150) for lang in STEMS]
    rows += [(900, None, "aa"), (901, "no language", None)]
    frame = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(4)
    model = language.fit(frame.filter("doc_id % 5 <> 0"))
    assert model.languages == ["aa", "bb", "gr"]
    got = language.language_columns(frame, model)
    assert got.columns == [*frame.columns, "lang_pred_", "score_"]
    held = [r for r in got.collect() if r["doc_id"] % 5 == 0 and r["doc_id"] < 900]
    assert sum(r["lang_pred_"] == r["lang"] for r in held) == len(held)

    mixed = text("aa", 40, rng) + " " + text("bb", 30, rng) + " " + text("gr", 20, rng)
    odd = [(1, mixed), (2, None), (3, ""), (4, "12 !!"), (5, text("gr", 40_000, rng)), (5, "β")]
    frame = spark.createDataFrame([(i, t, None, "", 0) for i, t in odd], SCHEMA)
    spans = {r["doc_id"]: r["spans"] for r in language.span_column(frame, model).collect()}
    assert [(s["lang"], s["n_words"]) for s in spans[1]] == [("aa", 40), ("bb", 30), ("gr", 20)]
    assert spans[2] == spans[3] == spans[4] == []
    by = [(r["lang_pred_"], r["score_"]) for r in language.language_columns(frame, model).collect()]
    assert by[1:4] == [("und", 0.0)] * 3 and by[4] == by[5] == ("gr", 1.0)
    assert by[0][0] == "aa" and 0.3 < by[0][1] < 0.6


def test_nothing_learned(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = language.fit(empty)
    one = spark.createDataFrame([(1, "abc", None, "", 0)], SCHEMA)
    assert language.language_columns(one, model).first()["lang_pred_"] == "und"
    assert language.language_columns(empty, model).count() == 0
