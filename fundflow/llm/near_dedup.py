"""Near-duplicate detection by ProbMinHash.

A text is the multiset of its runs of five words. ProbMinHash gives it
``bands * rows`` components; two texts agree in a component with the
probability of their probability Jaccard similarity J. Every element of a
text emits arrivals of a Poisson process whose rate is its count; each arrival
hits one component, the first arrival there wins, and an element stops once its
next arrival comes later than the latest winner of the text.

Components are cut into bands. Texts with an equal band are candidates:

1. Texts with the same words are one from here on.
2. In each bucket all are compared with the smallest, exactly. This is linear
   in the size of a bucket, however large, and links nearly everything.
3. What a bucket still holds of different components is compared in blocks of
   some thousand texts against one another. Within a block, pairs that are
   already connected are passed over, so are those that the triangle inequality
   excludes (1 - J is a metric: texts at distances d and e from the smallest are
   at least |d - e| apart) and those whose components agree so seldom that J is
   below the limit by five standard errors. The rest are compared exactly, the
   likeliest first. No pairs are emitted, only the links that connect.

Nothing is capped. A pair at similarity 0.8 shares no band with probability
6e-6 at 40 bands of 6 rows, and is passed over in step 3 with less than 2e-6
(binomial, 240 components).

Defined results: a text with fewer than five words is one run; a text without
words (NULL, empty) is in no group. Rows may repeat, ids too: every row counts
by itself. A class is named after its smallest id (NULL last), and that row
stays; of rows equal in it, one. An empty table has no classes. Extra columns
are carried by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import free_name, map_batches, plain, with_row_id, words_of, written

BANDS, ROWS = 40, 6
SHINGLE = 5
SIMILARITY = 0.8
#: Texts whose components are computed together; their number fits 14 bits.
_TOGETHER = 400
_HASH_BITS = 50
#: Texts of a bucket that are compared with one another in one block.
BLOCK = 1_000

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (constants of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _shingles(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 50-bit hash of every run of words; texts given by word hashes and offsets."""
    words = _mix(values.astype(np.int64).view(_U) + _U(0x9E3779B97F4A7C15))
    n = np.diff(offsets)
    text = np.repeat(np.arange(len(n)), n)
    reach = len(words) - SHINGLE + 1
    run = np.zeros(max(reach, 0), dtype=_U)
    for k in range(SHINGLE):
        run = run * _U(0xD6E8FEB86659FD93) + words[k : k + max(reach, 0)]
    inside = text[: max(reach, 0)] == text[SHINGLE - 1 :] if reach > 0 else np.zeros(0, bool)
    texts, runs = text[: len(run)][inside], run[inside]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        whole = [_fold_words(words[offsets[i] : offsets[i + 1]]) for i in short]
        texts, runs = np.concatenate([texts, short]), np.concatenate([runs, np.array(whole, _U)])
    return texts, _mix(runs) >> _U(64 - _HASH_BITS)


def _fold_words(words: np.ndarray) -> int:
    out = len(words)
    for w in words.tolist():
        out = (out * 0xD6E8FEB86659FD93 + w + 1) % 2**64
    return out


def _counted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct runs, sorted by text and hash."""
    texts, runs = _shingles(values, offsets)
    keys = np.sort(texts.astype(_U) << _U(_HASH_BITS) | runs)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    first = first.astype(np.int64)
    count = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> _U(_HASH_BITS)).astype(np.int64), keys & _U(2**_HASH_BITS - 1), count


def components(
    text: np.ndarray, run: np.ndarray, weight: np.ndarray, n_texts: int, size: int
) -> np.ndarray:
    """ProbMinHash: for each text the runs that win its ``size`` components.

    All elements take their first arrival, then those that can still win their
    second, and so on. Every text needs at least one element.
    """
    best = np.full(n_texts * size, np.inf)
    winner = np.zeros(n_texts * size, dtype=_U)
    latest = np.full(n_texts, np.inf)
    at = np.zeros(len(run))
    live = np.arange(len(run))
    turn = 0
    while len(live):
        turn += 1
        spread = _mix(run[live] * _U(0x9E3779B97F4A7C15) + _U(turn * 0xD1342543DE82EF95 % 2**64))
        uniform = ((spread >> _U(11)).astype(np.float64) + 0.5) / 2.0**53
        at[live] -= np.log(uniform) / weight[live]
        live = live[at[live] < latest[text[live]]]
        spread = _mix(run[live] + _U(turn * 0xA0761D6478BD642F % 2**64))
        slot = text[live] * size + (spread % _U(size)).astype(np.int64)
        time = at[live]
        np.minimum.at(best, slot, time)
        won = best[slot] == time
        winner[slot[won]] = run[live[won]]
        touched = np.unique(text[live])
        latest[touched] = best.reshape(n_texts, size)[touched].max(axis=1)
        live = live[at[live] < latest[text[live]]]
    return winner.reshape(n_texts, size)


def band_keys(
    values: np.ndarray, offsets: np.ndarray, bands: int, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key for each text and band, and the components; every text needs a word."""
    n_texts = len(offsets) - 1
    text, run, count = _counted(values, offsets)
    parts = components(text, run, count.astype(float), n_texts, bands * rows)
    won = parts.reshape(n_texts, bands, rows)
    keys = np.zeros((n_texts, bands), dtype=_U) + np.arange(1, bands + 1, dtype=_U)
    for k in range(rows):
        keys = _mix(keys * _U(0x9E3779B97F4A7C15) + won[:, :, k] + _U(1))
    return keys.view(np.int64), parts


def probability_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """J of two texts, given by the hashes of their words."""
    return _jaccard(*_runs(a), *_runs(b))


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct runs of one text, and their counts."""
    return _counted(np.asarray(words), np.array([0, len(words)], dtype=np.int64))[1:]


def _jaccard(ra: np.ndarray, ca: np.ndarray, rb: np.ndarray, cb: np.ndarray) -> float:
    at = np.minimum(np.searchsorted(rb, ra), len(rb) - 1)
    ia = np.flatnonzero(rb[at] == ra) if len(rb) else np.zeros(0, np.int64)
    ib = at[ia]
    if not len(ia):
        return 0.0
    if ca.max() == 1 and cb.max() == 1:
        return len(ia) / (len(ra) + len(rb) - len(ia))
    x = np.concatenate([ca, np.zeros(len(rb) - len(ib), dtype=ca.dtype)]).astype(float)
    y = np.zeros(len(x))
    y[ia] = cb[ib]
    y[len(ra) :] = np.delete(cb, ib)
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    r = ratio[order]
    below = np.cumsum(x[order])
    above = np.append(np.cumsum(y[order][::-1])[::-1], 0.0)
    # For an element with ratio t the terms up to ratio t count as x, those beyond as y / t.
    shared = np.flatnonzero((r > 0) & np.isfinite(r))
    last = np.searchsorted(r, r[shared], side="right")
    return float(np.sum(x[order][shared] / (below[last - 1] + above[last] / r[shared])))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


def _banded(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(lo, _TOGETHER)
                values, offsets = _flat(part.column(1))
                keys, won = band_keys(values, offsets, bands, rows)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel())
                )
                short = [w.tobytes() for w in _mix(won).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), flat, pa.array(short, pa.binary())],
                    ["row", "bands", "short"],
                )

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        (va, oa), (vb, ob) = _flat(batch.column(2)), _flat(batch.column(3))
        sims = [
            probability_jaccard(va[oa[k] : oa[k + 1]], vb[ob[k] : ob[k + 1]])
            for k in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sims, pa.float64())], ["a", "b", "sim"]
        )


def _linker(similarity: float, bands: int, rows: int):
    """Links that connect the texts of one block, or of two blocks against one another."""
    size = bands * rows
    least = similarity * size - 5 * np.sqrt(size * similarity * (1 - similarity))

    def run(block: pa.Table) -> pa.Table:
        ids = block["row"].to_numpy()
        order = np.argsort(ids, kind="stable")
        block = block.take(pa.array(order))
        ids = ids[order]
        chunk = block["chunk"].to_numpy()
        sim, band = block["sim"].to_numpy(), int(block["band"][0].as_py())
        across = block["i"][0].as_py() != block["j"][0].as_py()
        short = np.frombuffer(b"".join(block["short"].to_pylist()), dtype=np.uint8)
        short = short.reshape(len(ids), size)
        keys = block["bands"].combine_chunks().values.to_numpy(zero_copy_only=False)
        keys = keys.reshape(len(ids), bands)
        words = block["words"].combine_chunks()
        names, root = np.unique(block["label"].to_numpy(), return_inverse=True)
        runs: dict[int, tuple] = {}
        out: list[tuple[int, int]] = []

        def of(k: int) -> tuple:
            if k not in runs:
                runs[k] = _runs(words[k].values.to_numpy(zero_copy_only=False))
            return runs[k]

        for x in range(len(ids) - 1):
            rest = np.arange(x + 1, len(ids))
            rest = rest[
                (root[rest] != root[x]) & (np.abs(sim[rest] - sim[x]) <= 1 - similarity + 1e-9)
            ]
            if across:
                rest = rest[chunk[rest] != chunk[x]]
            if not len(rest):
                continue
            agree = (short[rest] == short[x]).sum(axis=1)
            likely = agree >= least
            rest, agree = rest[likely], agree[likely]
            # A pair belongs to its first common bucket; the short components may
            # agree by chance in a band before it.
            first = (keys[rest] == keys[x]).argmax(axis=1)
            rest, agree = rest[first == band], agree[first == band]
            for y in rest[np.argsort(-agree, kind="stable")].tolist():
                if root[y] != root[x] and _jaccard(*of(x), *of(y)) >= similarity - 1e-9:
                    out.append((int(ids[x]), int(ids[y])))
                    root[root == root[y]] = root[x]
        columns = list(zip(*out)) or [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return run


def similarities(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Exact J of pairs ``a``, ``b`` of row numbers.

    ``b`` should be the side with the many different rows: its words are moved
    first. The words of a row that is ``a`` in very many pairs are sent to
    each of them by a join whose large partitions adaptive execution splits.
    """
    both = (
        pairs.join(words.select(F.col("row").alias("b"), F.col("words").alias("wb")), "b")
        .join(words.select(F.col("row").alias("a"), F.col("words").alias("wa")), "a")
        .select("a", "b", "wa", "wb")
    )
    return map_batches(both, _compared, "a long, b long, sim double")


def connected(links: DataFrame) -> DataFrame:
    """Components of a graph: ``row`` and its component, the smallest row in it.

    Each round takes the smallest label among the neighbours, then the label of
    that label; a written table cuts the lineage. Stops when a round changes nothing.
    """
    both = written(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "links"
    )
    labels = written(
        both.groupBy(F.col("a").alias("row")).agg(F.min("b").alias("m"))
        .select("row", F.least("row", "m").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("row").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("row"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "row").select(
            "row", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("row").alias("label"), F.col("label").alias("next"))
        after = written(
            step.join(jump, "label", "left").select(
                "row", "old", F.least("label", "next").alias("label")
            ),
            "labels",
        )
        changed = after.filter("label <> old").limit(1).count()
        labels = after.select("row", "label")
        if not changed:
            return labels


def classes(
    docs: DataFrame,
    ident: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    row: str | None = None,
) -> DataFrame:
    """The class of every row: ``row``, ``id``, ``class_id``, ``class_size``, ``kept``.

    ``row`` names a column that numbers the rows; without it they are numbered here.
    """
    key, body = plain(docs, [ident, text])
    number = F.monotonically_increasing_id() if row is None else plain(docs, [row])[0]
    base = docs.select(
        number.alias("row"),
        key.cast("long").alias("id"),
        F.transform(words_of(body), lambda w: F.hash(w)).alias("words"),
    )
    base = written(base, "words", "zstd")
    keyed = base.filter(F.size("words") > 0).select(
        "row", F.xxhash64("words").alias("k"), F.xxhash64(F.lit(1), "words").alias("l")
    )
    same = keyed.groupBy("k", "l").agg(F.min("row").alias("first"))
    member = written(keyed.join(same, ["k", "l"]).select("row", "first"), "same-words")
    firsts = member.filter("row = first").select("row")

    # 1. Buckets of texts that differ.
    banded = map_batches(
        base.filter(F.size("words") > 0).select("row", "words"),
        _banded(bands, rows),
        "row long, bands array<long>, short binary",
    )
    banded = written(banded.join(firsts, "row", "left_semi"), "bands")
    entries = banded.select("row", F.posexplode("bands").alias("band", "bucket"))
    stars = (
        entries.groupBy("bucket")
        .agg(F.min("row").alias("star"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("bucket", "star")
    )
    inside = written(entries.join(stars, "bucket").filter("row <> star"), "buckets")
    words = base.select("row", "words")

    # 2. Each with the smallest of its bucket.
    pairs = inside.select(F.col("star").alias("a"), F.col("row").alias("b")).distinct()
    sims = written(similarities(pairs, words), "similarities")
    links = sims.filter(F.col("sim") >= similarity - 1e-9)
    parts = connected(links)

    # 3. Different components in one bucket, in blocks.
    placed = (
        inside.join(sims.select(F.col("a").alias("star"), F.col("b").alias("row"), "sim"),
                    ["star", "row"])
        .join(parts, "row", "left")
        .select("bucket", "band", "row", "sim", F.coalesce("label", "row").alias("label"))
    )
    placed = written(placed, "placed")
    open_buckets = (
        placed.groupBy("bucket")
        .agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n"))
        .filter("lo < hi")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"))
    )
    split = placed.join(open_buckets, "bucket").withColumn(
        "chunk", F.pmod(F.xxhash64("row"), F.col("chunks")).cast("int")
    )
    split = split.join(words, "row").join(banded, "row")
    met = split.withColumn(
        "with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    ).select(
        "bucket", "band", "row", "sim", "label", "words", "short", "bands", "chunk",
        F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"),
    )
    more = written(
        met.groupBy("bucket", "i", "j").applyInArrow(
            _linker(similarity, bands, rows), "a long, b long"
        ),
        "links",
    )
    if more.limit(1).count():
        parts = connected(links.select("a", "b").union(more))

    # Every row with its class; most rows are in none.
    grouped = member.join(parts.select(F.col("row").alias("first"), "label"), "first", "left").select(
        "row", F.coalesce("label", "first").alias("label")
    )
    numbered = base.select("row", "id").join(grouped, "row", "left").select(
        "row", "id", F.coalesce("label", "row").alias("label")
    )
    numbered = written(numbered, "classes")
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("row").alias("r"))
    named = numbered.groupBy("label").agg(
        F.min(order).alias("best"), F.count("*").alias("class_size")
    )
    return numbered.join(named, "label").select(
        "row",
        "id",
        F.col("best.i").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("best.r")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of every class, with all its columns."""
    number = free_name(docs, "row")
    # A copy of all texts stays on disk until the end, so it is packed well.
    fixed = written(with_row_id(docs, number), "numbered", "zstd")
    gone = classes(fixed, ident, text, row=number, **how).filter(~F.col("kept"))
    return fixed.join(
        gone.select(F.col("row").alias(number)), number, "left_anti"
    ).drop(number)
