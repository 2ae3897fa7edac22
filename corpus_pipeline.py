"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which ``run``
writes as Parquet and reads again as the next one's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fundflow.llm import bpe, decontaminate, near_dedup, toxicity
from fundflow.llm.common import table, written
from fundflow.llm.queries import TOXIC_AT, new_index, toxicity_lexicon, word_tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; labels are those of ``sf_dir``."""
    lexicon = toxicity_lexicon(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, lexicon, TOXIC_AT)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, by a new digest index."""
    return new_index(spark).drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each class of near copies."""
    return near_dedup.drop_near_copies(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens, their number, and the text they decode to."""
    return bpe.coded_columns(docs.select("doc_id", "text"), word_tokenizer(), keep=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("bpe", encode),
]

# Classes of near copies and learned weights are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
