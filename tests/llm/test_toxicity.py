from __future__ import annotations

import random
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from fundflow.llm import toxicity
from fundflow.llm.toxicity import Lexicon, fold

DOCS = "doc_id long, text string, score string, label int"
LABELS = "doc_id long, toxic int"


def test_folding():
    assert fold("You 1D10T!") == " you idiot "
    assert fold("stуpid tr@sh lоs3r") == fold("stypid trash loser")
    assert fold("a$s a$$ $5 100 cats***") == " ass a 5 100 cats "
    assert fold(None) == fold(" .. ") == ""


def test_hits_equal_a_plain_search():
    weights = {" bad ": 2.0, " bad": 1.0, " badly": 3.0, " worse ": 1.5}
    lexicon = Lexicon(dict(weights), [" not bad ", " bad luck "])
    rng = random.Random(2)
    for _ in range(300):
        words = rng.choices(["bad", "badly", "badger", "worse", "not", "luck", "x"], k=rng.randrange(8))
        want = []
        for k, w in enumerate(words):
            found = [(len(e), v) for e, v in weights.items() if f" {w} ".startswith(e)]
            free = (w == "bad" and words[k - 1 : k] == ["not"] and k) or (
                w == "bad" and words[k + 1 : k + 2] == ["luck"]
            )
            if found and not free:
                want.append(max(found)[1])
        assert sorted(lexicon.hits(fold(" ".join(words)))) == sorted(want)


def corpus(n=900):
    rng = random.Random(1)
    docs, labels = [], []
    for k in range(n):
        words = [f"{rng.choice('bcdfgh')}{rng.randrange(300)}word" for _ in range(rng.randrange(20, 60))]
        toxic = k % 4 == 0
        if toxic:
            words[3], words[9] = rng.choice(["idiot", "1diot", "scum"]), "moron"
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def test_learned_lexicon_separates_held_out_texts(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], DOCS).repartition(4)
    known = spark.createDataFrame([*labels, (0, None), (None, 1), (5, 0)], LABELS)
    lexicon = toxicity.fit(frame, known)
    scored = toxicity.score_column(frame, lexicon)
    assert scored.columns == [*frame.columns, "score_"]
    got = {r["doc_id"]: r["score_"] for r in scored.collect()}
    wrong = [k for k, toxic in labels if (got[k] >= 0.3) != bool(toxic)]
    assert len(wrong) <= 5
    kept = toxicity.keep_clean(frame, lexicon)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k in got if got[k] < 0.3}
    odd = spark.createDataFrame(
        [(1, None, "", 0), (2, "", "", 0), (3, "idiot moron " * 50_000, "", 0), (3, "idiot", "", 0)],
        DOCS,
    )
    by = toxicity.score_column(odd, lexicon).collect()
    assert by[0]["score_"] == by[1]["score_"] < 0.3
    assert all(0 <= r["score_"] <= 1 for r in by) and by[2]["score_"] >= 0.3


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "idiot", "", 0)], DOCS)
    lexicon = toxicity.fit(docs, spark.createDataFrame([], LABELS))
    assert toxicity.score_column(docs, lexicon).first()["score_"] == 0.0
    assert toxicity.keep_clean(spark.createDataFrame([], DOCS), lexicon).count() == 0


@given(st.lists(st.sampled_from(["a", "ö", "1", "0", "5", "2", "!", "@", "|", "_", " ", "²", "Z"]), max_size=14).map("".join))
def test_signs_become_letters_where_they_touch_one(text):
    """The rule as three alternatives, tried at every place."""
    letter, digits = r"[^\W\d_]", "[0134578]+"
    rule = re.compile(rf"(?<={letter})[0134578@$!|]+(?={letter})|(?<={letter}){digits}|{digits}(?={letter})")
    plain = rule.sub(lambda m: m.group().translate(toxicity._SIGNS), text.lower())
    assert toxicity._SIGN_RUN.sub(toxicity._letters_of, text.lower()) == plain


@pytest.mark.parametrize("unit", ["1", "!1", "a", "a1", "漢", "1!@", "!"])
def test_long_runs_are_folded_in_one_pass(unit):
    started = time.monotonic()
    toxicity.fold(unit * (1_000_000 // len(unit)))
    assert time.monotonic() - started < 10
