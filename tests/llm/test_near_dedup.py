from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fundflow.llm import near_dedup
from fundflow.llm.common import written

SCHEMA = "doc_id long, text string, row string, label int"


def runs(text: str | None) -> Counter:
    words = re.findall(r"\w+", (text or "").lower())
    if not words:
        return Counter()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute_jaccard(x: Counter, y: Counter) -> float:
    keys = set(x) | set(y)
    return sum(
        1 / sum(max(x[k] / x[d], y[k] / y[d]) for k in keys) for d in set(x) & set(y)
    )


def brute_classes(rows: list[tuple]) -> dict[int, int]:
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: runs(t) for i, t in rows}
    for a, b in combinations(sorted(sets), 2):
        if set(sets[a]) & set(sets[b]) and find(a) != find(b):
            if brute_jaccard(sets[a], sets[b]) >= 0.8:
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {i: find(i) for i in root}


def edited(words: list[str], n: int, rng: random.Random) -> str:
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return " ".join(out)


def test_similarity_equals_its_definition():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.integers(0, 6, rng.integers(1, 50)).astype(np.int32)
        b = np.concatenate([a, rng.integers(0, 6, rng.integers(0, 20)).astype(np.int32)])
        b[rng.integers(0, len(b))] = 9
        x, y = (runs(" ".join(map(str, v.tolist()))) for v in (a, b))
        assert near_dedup.probability_jaccard(a, b) == pytest.approx(brute_jaccard(x, y))


def test_components_agree_as_often_as_the_similarity_says():
    rng = np.random.default_rng(2)
    agree, true = [], []
    for _ in range(60):
        a = rng.integers(0, 30, 200).astype(np.int32)
        b = a.copy()
        b[rng.integers(0, 200, 4)] = 77
        text, run, count = near_dedup._counted(np.concatenate([a, b]), np.array([0, 200, 400]))
        won = near_dedup.components(text, run, count.astype(float), 2, 240)
        agree.append((won[0] == won[1]).mean())
        true.append(near_dedup.probability_jaccard(a, b))
    assert np.mean(agree) == pytest.approx(np.mean(true), abs=0.015)


def test_components_do_not_depend_on_the_company():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 30, n).astype(np.int32) for n in (40, 5_000))
    one = near_dedup.band_keys(a, np.array([0, 40]), 40, 6)[0]
    two = near_dedup.band_keys(np.concatenate([b, a]), np.array([0, 5_000, 5_040]), 40, 6)[0]
    assert (one[0] == two[1]).all()


def test_groups_with_many_edits_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 30)
    rng = random.Random(4)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, edited(base, rng.randrange(0, 8), rng)) for k in range(60)]
    rows += [(200 + k, edited(base[:150] + [f"c{k}"] * 50, 2, rng)) for k in range(10)]
    rows += [(300 + k, " ".join(f"x{rng.randrange(50)}" for _ in range(80))) for k in range(20)]
    frame = spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA).repartition(5)
    got = {r["id"]: r["class_id"] for r in near_dedup.classes(frame).collect()}
    want = brute_classes(rows)
    assert got == want
    assert len(set(want.values())) < 90


def test_edge_cases(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " .,! "), (4, "one two"), (5, "One, two!"), (6, "one"),
        (7, long), (8, long + " end"), (None, "a b c d e f"), (9, "a b c d e f"),
        (9, "a b c d e f"), (10, "a a a a a a a a a"), (11, "a a a a a a a a"),
    ]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], SCHEMA)
    got = near_dedup.classes(frame).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    assert [by[i]["class_id"] for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 4, 6, 7, 7]
    assert by[None]["class_id"] == 9 and by[None]["class_size"] == 3
    # The same runs in another number are the same distribution.
    assert by[11]["class_id"] == 10
    assert sum(r["kept"] for r in got if r["class_id"] == 9) == 1
    kept = near_dedup.drop_near_copies(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 7, 9, 10]


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert near_dedup.classes(frame).count() == 0
    assert near_dedup.drop_near_copies(frame).count() == 0


def test_long_chain_is_one_component(spark):
    rows = [(k, k + 1) for k in range(20)] + [(100, 101)]
    links = spark.createDataFrame(rows, "a long, b long")
    got = {r["row"]: r["label"] for r in near_dedup.connected(links).collect()}
    assert got == {k: 0 for k in range(21)} | {100: 100, 101: 100}


def test_a_chance_agreement_in_an_earlier_band_loses_no_pair():
    """Short components that agree before the first common bucket; the pair has no other link."""
    bands, rows, n = near_dedup.BANDS, near_dedup.ROWS, 60
    rng = np.random.default_rng(5)
    link = near_dedup._linker(near_dedup.SIMILARITY, bands, rows)
    planted = 0
    while planted < 3:
        words = rng.integers(0, 10**6, (400, n)).astype(np.int32)
        words[1::2] = words[::2]
        words[1::2, n - 5] += 1
        offsets = np.arange(0, words.size + 1, n)
        keys, won = near_dedup.band_keys(words.ravel(), offsets, bands, rows)
        short = near_dedup._mix(won).astype(np.uint8)
        for a in range(0, 400, 2):
            shared = np.flatnonzero(keys[a] == keys[a + 1])
            by_chance = (short[a] == short[a + 1]).reshape(bands, rows).all(axis=1)
            if not len(shared) or by_chance.argmax() == shared[0]:
                continue
            planted += 1
            assert near_dedup.probability_jaccard(words[a], words[a + 1]) >= near_dedup.SIMILARITY
            found = []
            for band in shared.tolist():
                block = pa.table({
                    "row": [7, 8], "chunk": [0, 0], "i": [0, 0], "j": [0, 0], "sim": [0.5, 0.5],
                    "band": [band] * 2, "bucket": [int(keys[a, band])] * 2, "label": [7, 8],
                    "short": [short[a + k].tobytes() for k in (0, 1)],
                    "bands": [keys[a + k].tolist() for k in (0, 1)],
                    "words": pa.array([words[a + k].tolist() for k in (0, 1)], pa.list_(pa.int32())),
                })
                found += link(block).to_pylist()
            assert found == [{"a": 7, "b": 8}]


def test_copies_of_all_texts_are_packed(spark, monkeypatch):
    kept = {}

    def spy(frame, label, *how):
        kept[label] = written(frame, label, *how)
        return kept[label]

    monkeypatch.setattr(near_dedup, "written", spy)
    docs = spark.createDataFrame([(k, f"a b c d e {k}") for k in range(9)], "doc_id long, text string")
    assert near_dedup.drop_near_copies(docs).count() == 9
    for label in ("numbered", "words"):
        for file in kept[label].inputFiles():
            group = pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0)
            assert group.column(0).compression == "ZSTD", label
