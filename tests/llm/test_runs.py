from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from fundflow.llm import common, queries, runs


def brute(words):
    """Every lag tried from every place; of equal stretches the smallest period."""
    found = {}
    for lag in range(1, len(words) // runs.MIN_TIMES + 1):
        at = 0
        while at + lag < len(words):
            end = at
            while end + lag < len(words) and words[end] == words[end + lag]:
                end += 1
            if end + lag - at >= max(runs.MIN_WORDS, runs.MIN_TIMES * lag):
                found.setdefault((at, end + lag), lag)
            at = max(end, at + 1)
    return sorted((a, e - a, q) for (a, e), q in found.items())


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def spoiled(rnd):
    """Random words with blocks repeated in them, some of the blocks with repeats inside."""
    words = [rnd.choice("abc") for _ in range(rnd.choice([0, 3, 40, 200]))]
    for _ in range(rnd.randrange(4)):
        block = [rnd.choice("abcde" * rnd.randrange(1, 4) + "xyz") for _ in range(rnd.randrange(1, 90))]
        if rnd.random() < 0.4:
            block += block[: rnd.randrange(len(block))] + block
        length = int(len(block) * rnd.uniform(1.5, 6))
        at = rnd.randrange(len(words) + 1)
        words[at:at] = [block[i % len(block)] for i in range(length)]
    return words[:1500]


def test_batches_equal_brute_force():
    rnd = random.Random(5)
    n = 0
    for _ in range(12):
        texts = [spoiled(rnd) for _ in range(15)]
        found, joined, counts = runs.runs_of_texts(pa.array([" \t".join(t) + "\n" for t in texts]))
        for words, mine, text, count in zip(texts, found, joined, counts):
            want = brute(words)
            n += len(want)
            assert [tuple(r) for r in mine.tolist()] == want
            assert text == collapsed(words, want) and count == len(words)
    assert n > 100


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=120), st.integers(1, 40), st.integers(1, 5))
def test_few_letters(words, block, times):
    words = words + words[:block] * times + ["a", "b"]
    [found], _, _ = runs.runs_of_texts(pa.array([" ".join(words)]))
    assert [tuple(r) for r in found.tolist()] == brute(words)


def test_scales_cover_every_period_once():
    covered = [q for s in runs.scales(3000) for q in range(s.first, s.block + 1)]
    assert covered == list(range(runs.SHORT + 1, covered[-1] + 1)) and covered[-1] >= 1000
    for s in runs.scales(10**6):
        # A window and the same window one period further lie within three periods.
        assert s.window >= 1 and 2 * s.first >= s.block + s.window - 1


def test_long_texts_and_long_periods():
    same = "a " * 300_000
    block = [str(k) for k in range(90_000)]
    [a, b, c], _, counts = runs.runs_of_texts(
        pa.array([same, " ".join(block * 3 + block[:7]), " ".join(map(str, range(200_000)))])
    )
    assert a.tolist() == [[0, 300_000, 1]]
    assert b.tolist() == [[0, 270_007, 90_000]]
    assert len(c) == 0 and counts.tolist() == [300_000, 270_007, 200_000]


def test_words_are_cut_at_ascii_blanks_only():
    flat, counts = common.split_words(pa.array(["a b\x1cc d\x0be", " \t", "", None, "x  y"]))
    assert flat.to_pylist() == ["a b\x1cc d", "e", "x", "y"]
    assert counts.tolist() == [2, 0, 0, 0, 2]


def test_strongest_breaks_ties():
    assert runs.strongest([]) is None
    assert runs.strongest([[9, 30, 10], [2, 60, 20], [2, 30, 10]]) == [2, 30, 10]
    assert runs.strongest([[0, 10**15, 3 * 10**14], [5, 10**15 + 1, 3 * 10**14]])[0] == 5


def test_frames_with_odd_rows(spark):
    schema = "runs int, doc_id long, text string, `n.words` string"
    rows = [(1, 1, None, "x"), (2, 2, "", None), (3, None, "go on " * 20, "y"), (3, None, "go on " * 20, "y")]
    out = runs.run_columns(spark.createDataFrame(rows, schema))
    assert out.columns == ["runs", "doc_id", "n.words", "n_words", "runs_", "strongest", "collapsed"]
    got = sorted(out.collect(), key=lambda r: r["runs"])
    assert [(r["n_words"], r["collapsed"], r["strongest"]) for r in got[:2]] == [(0, "", None)] * 2
    assert [tuple(r["strongest"]) for r in got[2:]] == [(0, 40, 2)] * 2
    assert got[2]["collapsed"] == "go on"
    assert runs.run_columns(spark.createDataFrame([], schema)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(11)
    texts = [" ".join(spoiled(rnd)) for _ in range(120)] + [None, "", " \n"]
    rows = [(k, t) for k, t in enumerate(texts)]
    zero = [i for i in range(500, 2000) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows += list(zip(zero, ["", None, "one", "one two", " ".join(str(k) for k in range(300))]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op13_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    looped = 0
    for ident, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(ident).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            looped += 1
        want = brute(words)
        row = got[ident]
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in want)
        best = runs.strongest([list(r) for r in want])
        assert row["n_runs"] == len(want)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, want).encode()).hexdigest()
        assert [row["start"], row["length"], row["period"]] == (best or [None] * 3)
        assert row["exponent_milli"] == (best and 1000 * best[1] // best[2])
    assert looped > 5


def test_sliding_windows():
    values = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for width in range(1, 8):
        want = [min(values[i : i + width]) for i in range(8 - width)]
        assert runs._sliding(values, width, np.minimum).tolist() == want
