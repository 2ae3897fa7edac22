"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are sequences of lower-case words. Windows of
``min_tile`` words are hashed by Karp-Rabin; documents and items are joined on
windows they share. For each such pair, shared windows along a diagonal make up
the longest matches; the longest is marked as a tile, what the others have left
beside it is put back, and so on until no match of ``min_tile`` words is left.
The share of an item's words under tiles is its coverage, whatever the order of
the tiles in the document.

The benchmark goes to the executors in blocks of at most ``block_chars``
characters (an item stays whole); the documents are read once for each block
and are never shuffled.

Defined results: a NULL or empty text has no words and no matches; an item with
fewer words than ``min_tile`` is never found; repeated items are looked for
once, repeated documents each get their rows; an empty benchmark finds nothing.
Ties between matches go to the first in the item, then in the document.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import map_batches, plain

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_CHARS = 16_000_000

_WORD = re.compile(r"\w+")
_BASE = 0x9E3779B97F4A7C15
_FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("n_tiles", T.IntegerType()),
        T.StructField("longest_tile", T.IntegerType()),
    ]
)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows: each is the last one rolled on by a word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    rolled = np.zeros(n, dtype=np.uint64)
    base = np.uint64(_BASE)
    for k in range(size):
        rolled = rolled * base + words[k : k + n].astype(np.uint64) + np.uint64(1)
    return rolled


def tiles(
    doc: np.ndarray, item: np.ndarray, at_doc: np.ndarray, at_item: np.ndarray, size: int
) -> list[tuple[int, int, int]]:
    """Greedy tiling from the pairs of places whose windows agree: doc place, item place, length."""
    same = np.ones(len(at_doc), dtype=bool)
    for k in range(size):
        same &= doc[at_doc + k] == item[at_item + k]
    at_doc, at_item = at_doc[same], at_item[same]
    if not len(at_doc):
        return []
    order = np.lexsort((at_doc, at_doc - at_item))
    d, i = at_doc[order], at_item[order]
    breaks = np.flatnonzero((np.diff(d) != 1) | (np.diff(d - i) != 0)) + 1
    starts = np.concatenate([[0], breaks])
    lengths = np.diff(np.append(starts, len(d))) + size - 1
    queue = [(-int(n), int(i[s]), int(d[s])) for s, n in zip(starts, lengths)]
    heapq.heapify(queue)
    doc_free, item_free = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    out = []
    while queue:
        negative, b, a = heapq.heappop(queue)
        n = -negative
        free = doc_free[a : a + n] & item_free[b : b + n]
        if free.all():
            out.append((a, b, n))
            doc_free[a : a + n] = False
            item_free[b : b + n] = False
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if hi - lo >= size:
                heapq.heappush(queue, (lo - hi, b + lo, a + lo))
    return out


@dataclass
class Block:
    """Items of a benchmark with a table of their windows."""

    ids: list[int | None]
    words: list[np.ndarray]
    vocabulary: dict[str, int]
    size: int
    hashes: np.ndarray  # of all windows, sorted
    items: np.ndarray  # item of each
    places: np.ndarray  # place of each in its item

    @classmethod
    def build(cls, rows: list[tuple[int | None, str | None]], size: int) -> Block:
        vocabulary: dict[str, int] = {}
        words = [
            np.array(
                [vocabulary.setdefault(w, len(vocabulary)) for w in _WORD.findall((t or "").lower())],
                dtype=np.int64,
            )
            for _, t in rows
        ]
        hashed = [windows(w, size) for w in words]
        counts = [len(h) for h in hashed]
        hashes = np.concatenate([np.zeros(0, np.uint64), *hashed])
        items = np.repeat(np.arange(len(rows)), counts)
        places = np.concatenate([np.zeros(0, np.int64), *[np.arange(n) for n in counts]])
        order = np.argsort(hashes, kind="stable")
        return cls(
            [i for i, _ in rows], words, vocabulary, size, hashes[order], items[order], places[order]
        )

    def search(self, text: str | None, coverage: float) -> list[tuple]:
        """Items that cover enough: id, coverage, number of tiles, longest."""
        if not text or not len(self.hashes):
            return []
        known = self.vocabulary.get
        found = _WORD.findall(text.lower())
        doc = np.fromiter((known(w, -1) for w in found), dtype=np.int64, count=len(found))
        rolled = windows(doc, self.size)
        first = np.searchsorted(self.hashes, rolled, side="left")
        hit = np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == rolled)
        if not len(hit):
            return []
        last = np.searchsorted(self.hashes, rolled[hit], side="right")
        n = last - first[hit]
        entry = np.repeat(first[hit] - np.cumsum(n) + n, n) + np.arange(n.sum())
        at_doc, item, at_item = np.repeat(hit, n), self.items[entry], self.places[entry]
        out = []
        for k in np.unique(item).tolist():
            mine = item == k
            words = self.words[k]
            # Words that can be covered at all: cheap, and exact as an upper bound.
            reach = np.zeros(len(words) + 1, dtype=np.int64)
            starts = np.unique(at_item[mine])
            reach[starts] += 1
            np.subtract.at(reach, starts + self.size, 1)
            if np.count_nonzero(np.cumsum(reach)[:-1] > 0) < coverage * len(words):
                continue
            tiled = tiles(doc, words, at_doc[mine], at_item[mine], self.size)
            share = sum(t[2] for t in tiled) / len(words)
            if tiled and share >= coverage:
                out.append((self.ids[k], share, len(tiled), max(t[2] for t in tiled)))
        return out


def blocks(
    benchmark: DataFrame, size: int = MIN_TILE, block_chars: int = BLOCK_CHARS
) -> Iterator[Block]:
    """The benchmark in bounded blocks, one after the other on the driver."""
    ident, text = plain(benchmark, ["item_id", "text"])
    items = benchmark.select(ident.cast("long").alias("id"), text.alias("text")).filter(
        "length(text) > 0"
    ).distinct()
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = -(-int(total) // block_chars) if total else 0
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(count, 1)))
    for k in range(count):
        rows = items.filter(part == k).orderBy("id", "text")
        batch: list[tuple[int | None, str]] = []
        chars = 0
        for row in rows.toLocalIterator():
            if batch and chars + len(row["text"]) > block_chars:
                yield Block.build(batch, size)
                batch, chars = [], 0
            batch.append((row["id"], row["text"]))
            chars += len(row["text"])
        if batch:
            yield Block.build(batch, size)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    size: int = MIN_TILE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item of which it holds at least ``coverage``."""
    ident, text = plain(docs, ["doc_id", "text"])
    rows = docs.select(ident.cast("long").alias("doc_id"), text.alias("text"))
    out = rows.sparkSession.createDataFrame([], _FOUND)
    for block in blocks(benchmark, size, block_chars):
        sent = rows.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [
                    (doc, *hit)
                    for doc, body in zip(*(c.to_pylist() for c in batch.columns))
                    for hit in sent.value.search(body, coverage)
                ]
                columns = list(zip(*hits)) or [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], _FOUND.names
                )

        out = out.union(map_batches(rows, run, _FOUND))
    return out


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    size: int = MIN_TILE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows that hold no item to that degree, with all their columns."""
    at = docs.columns.index("text")
    for block in blocks(benchmark, size, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at).to_pylist()
                yield batch.filter(pa.array([not sent.value.search(t, coverage) for t in texts]))

        docs = map_batches(docs, run, docs.schema)
    return docs
