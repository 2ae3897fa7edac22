from __future__ import annotations

import hashlib
import time
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fundflow.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, n_tokens string, tokens int"


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


def agree(tokenizer, reference, text):
    want = reference.encode(text, add_special_tokens=False).ids
    got = tokenizer.encode(text)
    assert got == want, text[:80]
    assert tokenizer.decode(got) == reference.decode(want, skip_special_tokens=False)


def merged_by_rank(text, ranks):
    """Plain byte-pair encoding: merge the leftmost pair of lowest rank."""
    parts = list(text)
    while True:
        pairs = [(ranks[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not pairs:
            return parts
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_automaton_equals_merging_by_rank_on_random_merges():
    rng = random.Random(5)
    for _ in range(60):
        vocab = {c: k for k, c in enumerate("abc")}
        merges = []
        while len(merges) < 12:
            left, right = rng.choice(list(vocab)), rng.choice(list(vocab))
            if left + right not in vocab and len(left + right) < 8:
                merges.append((left, right))
                vocab[left + right] = len(vocab)
        automaton = bpe.TokenAutomaton.compile(vocab, merges)
        ranks = {m: k for k, m in enumerate(merges)}
        for _ in range(40):
            text = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 14)))
            parts = merged_by_rank(text, ranks)
            ids = [vocab[p] for p in parts]
            assert all(t in automaton.live for t in ids)
            assert all(automaton.follows(a, b) for a, b in zip(ids, ids[1:]))


EDGES = [
    "", " ", "\n\t ", "a" * 3_000, "Don't I'LL we'Ve 's'", "0123 4567", "İstanbul ΣΑΣ",
    "été Å ﬁ ½ ²", "日本語 한국어 ไทย", "👍🏽👨‍👩‍👧 ok!!", "a\x1cb\x85c　d", "</w> <w>",
    "<|endoftext|> hi<|startoftext|><|endoftext|>", "$$$ ,,, ...!!!??", "\x00\x01",
]


@pytest.mark.parametrize("text", EDGES)
def test_edge_texts_equal_the_library(tokenizer, reference, text):
    agree(tokenizer, reference, text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text_equals_the_library(tokenizer, reference, text):
    agree(tokenizer, reference, text)


def test_every_code_point_equals_the_library(tokenizer, reference):
    for lo in range(0, len(bpe._EVERY), 512):
        text = "".join(f"{c} a{c}B " for c in bpe._EVERY[lo : lo + 512])
        agree(tokenizer, reference, text)


@pytest.mark.parametrize("letter", ["a", "漢", "1", "x!"])
def test_one_long_word(tokenizer, reference, letter):
    text = letter * (1_000_000 // len(letter))
    started = time.monotonic()
    ids = tokenizer.encode(text)
    assert time.monotonic() - started < 20
    assert tokenizer.decode(ids).replace("</w>", "").replace(" ", "") != ""
    if letter == "a":
        agree(tokenizer, reference, text[:20_000])


def test_columns(spark, tokenizer, reference):
    long = "Word after word, " * 20_000
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, long)]
    frame = spark.createDataFrame([(i, t, "n", 0) for i, t in rows], SCHEMA)
    coded = bpe.encode_column(frame, tokenizer, out="ids")
    assert coded.columns == [*frame.columns, "ids", "n_tokens_"]
    back = bpe.decode_column(coded, tokenizer, tokens="ids").collect()
    for row in back:
        want = reference.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == want and row["n_tokens_"] == len(want)
        assert row["decoded"] == reference.decode(want, skip_special_tokens=False)
    for row in bpe.round_trip_digests(frame, tokenizer).collect():
        ids = reference.encode(row["text"] or "", add_special_tokens=False).ids
        text = " ".join(map(str, ids))
        assert row["ids_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.round_trip_digests(empty, tokenizer).count() == 0
