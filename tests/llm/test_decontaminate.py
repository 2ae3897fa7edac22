from __future__ import annotations

import random

from fundflow.llm import decontaminate
from fundflow.llm.decontaminate import Block

DOCS = "doc_id long, text string, item_id string, coverage int"
ITEMS = "item_id long, text string"


def brute(doc, item, size):
    """Greedy tiling by trying every pair of places, one tile at a time."""
    doc_free, item_free, covered = [True] * len(doc), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while (
                    i + k < len(doc) and j + k < len(item) and doc_free[i + k]
                    and item_free[j + k] and doc[i + k] == item[j + k]
                ):
                    k += 1
                if k > best[0]:
                    best = (k, j, i)
        n, j, i = best
        if n < size:
            return covered
        covered += n
        doc_free[i : i + n] = [False] * n
        item_free[j : j + n] = [False] * n


def test_coverage_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        letters = "abcdef"[: rng.choice([2, 3, 6])]
        item = [rng.choice(letters) for _ in range(rng.randrange(3, 25))]
        doc = [rng.choice(letters) for _ in range(rng.randrange(60))]
        if rng.random() < 0.5:
            cut = rng.randrange(len(item))
            doc = doc[:10] + item[cut:] + doc[10:] + item[:cut]
        found = Block.build([(1, " ".join(item))], 3).search(" ".join(doc), 0.0)
        got = round(found[0][1] * len(item)) if found else 0
        assert got == brute(doc, item, 3)


def setting(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(rng.choices(words, k=30))) for k in range(20)]
    items += [(20, "too short"), (21, None), (3, items[3][1]), (22, items[4][1])]
    text = items[3][1].split()
    clean = " ".join(rng.choices(words, k=200))
    docs = [
        (1, clean + " " + items[3][1].upper() + "!"),
        (2, clean + " " + " ".join(text[20:] + ["x"] + text[10:20] + ["y"] + text[:10])),
        (3, clean + " " + " ".join(text[:10])),
        (4, clean), (5, None), (6, ""), (None, items[3][1]), (7, items[4][1]), (7, items[4][1]),
        (8, (clean + " ") * 500 + items[5][1]),
    ]
    return (
        spark.createDataFrame([(i, t, "z", 1) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame(items, ITEMS),
    )


def test_whole_and_reordered_passages_are_found(spark):
    docs, items = setting(spark)
    for block_chars in (10**6, 600):
        found = decontaminate.contaminated(docs, items, block_chars=block_chars).collect()
        pairs = sorted(((r["doc_id"] or 0, r["item_id"]) for r in found))
        assert pairs == [(0, 3), (1, 3), (2, 3), (7, 4), (7, 4), (7, 22), (7, 22), (8, 5)]
        assert {r["n_tiles"] for r in found if r["doc_id"] == 2} == {3}
        kept = decontaminate.drop_contaminated(docs, items, block_chars=block_chars)
        assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6]
        assert kept.columns == docs.columns


def test_empty_tables(spark):
    docs, items = setting(spark)
    nothing, no_items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.contaminated(docs, no_items).count() == 0
    assert decontaminate.drop_contaminated(docs, no_items).count() == docs.count()
