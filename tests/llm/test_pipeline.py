from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline

from fundflow.llm.decontaminate import Block
from fundflow.llm.queries import REGISTRY, toxicity_lexicon
from fundflow.sources.workspace import new_folder
from tests.llm.test_near_dedup import brute_classes

SF = "/root/testdata/sf0.001"


def bare(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def test_stages_equal_brute_force(spark):
    """Every stage on what the one before it kept, against plain Python over the same rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    reference = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "toxicity":
            lexicon = toxicity_lexicon(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            want = {i for i, t in before.items() if lexicon.score(t) < 0.3}
        elif name == "exact_dedup":
            best = {}
            for i, t in sorted(before.items()):
                key = bare(t)
                if key not in best or len(t or "") > len(before[best[key]] or ""):
                    best[key] = i
            want = set(best.values())
        elif name == "near_dedup":
            want = {i for i, c in brute_classes(list(before.items())).items() if i == c}
        elif name == "decontamination":
            block = Block.build(bench, 5)
            want = {i for i, t in before.items() if not block.search(t, 0.5)}
        else:
            want = set(before)
        path = new_folder(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert {r["doc_id"] for r in after.select("doc_id").collect()} == want, name
        assert after.count() == len(want)
        if name != "bpe":
            assert after.columns == docs.columns
        docs = after
    for row in docs.collect():
        ids = reference.encode(before[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["tokens"] == ids and row["n_tokens"] == len(ids)
        assert row["decoded"] == reference.decode(ids, skip_special_tokens=False)


def test_registry_has_a_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in REGISTRY)
    assert numbers == list(range(1, 14))
