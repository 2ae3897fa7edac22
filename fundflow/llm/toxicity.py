"""Toxicity by a weighted lexicon.

A text is folded (look-alike letters of other scripts, digits and signs that
stand for letters), reduced to words, and searched by one Aho-Corasick pass for
lexicon entries: whole words and beginnings of words. Of several entries in one
word the longest counts. An entry inside an exception phrase does not count.
The weights found are summed, set against the length of the text, and turned
into a score by a logistic curve.

Lexicon, weights, exception phrases and curve are learned from labelled rows.
A given lexicon can be added to the learned one.

Defined results: NULL and empty texts score as a text without a match; without
labels every score is 0; a NULL label or id is not learned from; of repeated
labels of one id the highest counts; repeated rows each get their score; extra
columns are carried.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import free_name, map_batches, plain, written

# Letters that look like a Latin one, and what is written for it.
_LOOK_ALIKE = str.maketrans(
    "абвгеёзікмнорстухјѕԁһԛԝαβγεικνορτυχ"
    "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ",
    "abbreeзikmhopctyxjsdhqwabyeiknoptux"
    "abcdefghijklmnopqrstuvwxyz",
)
_SIGNS = str.maketrans("0134578@$!|", "oieastbasil")
_HAS_LOOK_ALIKE = re.compile(f"[{re.escape(''.join(map(chr, _LOOK_ALIKE)))}]")
# A run of digits or signs that touches a letter; signs only between letters. No branch goes
# back into a run, and the last one begins where a run does, so a run is read once.
_LETTER = r"[^\W\d_]"
_DIGITS = "0134578"
_SIGN_RUN = re.compile(
    rf"(?<={_LETTER})(?:[{_DIGITS}@$!|]++(?={_LETTER})|[{_DIGITS}]++)"
    rf"|(?<![{_DIGITS}@$!|])(?P<lead>[{_DIGITS}@$!|]++)(?={_LETTER})"
)
_GAPS = re.compile(r"[\W_]+")

MIN_PREFIX, MAX_PREFIX = 4, 8


def _letters_of(run: re.Match) -> str:
    """A run as letters; before a word only the digits that end it."""
    signs = (run["lead"] or "").rstrip(_DIGITS)
    return signs + run.group()[len(signs) :].translate(_SIGNS)


def fold(text: str | None) -> str:
    """Words of a text with one blank before, between and after; empty if there are none."""
    text = (text or "").lower()
    if not text.isascii() and _HAS_LOOK_ALIKE.search(text):
        text = text.translate(_LOOK_ALIKE)
    text = _SIGN_RUN.sub(_letters_of, text)
    words = _GAPS.sub(" ", text).strip()
    return f" {words} " if words else ""


@dataclass
class Lexicon:
    """Entries with weights: ``" word "`` is a whole word, ``" begin"`` a beginning."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)  # phrases as " two words "
    curve: tuple[float, ...] = ()
    _tree: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_tree": None}

    def tree(self) -> ahocorasick.Automaton:
        if self._tree is None:
            self._tree = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._tree.add_word(entry, (entry, weight))
            for phrase in self.exceptions:
                self._tree.add_word(phrase, (phrase, None))
            self._tree.make_automaton()
        return self._tree

    def hits(self, folded: str) -> list[float]:
        """Weights of the words that match, outside exception phrases."""
        if not self.weights or not folded:
            return []
        best: dict[int, tuple[int, float]] = {}  # first letter: length and weight of the entry
        free: list[tuple[int, int]] = []
        for end, (entry, weight) in self.tree().iter(folded):
            start = end - len(entry) + 1
            if weight is None:
                free.append((start, end))
            elif len(entry) > best.get(start, (0, 0.0))[0]:
                best[start] = (len(entry), weight)
        if not free:
            return [w for _, w in best.values()]
        inside = np.zeros(len(folded) + 1, dtype=np.int32)
        for start, end in free:
            inside[start] += 1
            inside[end] -= 1
        covered = np.cumsum(inside) > 0
        return [w for at, (_, w) in best.items() if not covered[at]]

    def features(self, text: str | None) -> tuple[float, ...]:
        """What the curve is drawn over: the sum of weights, plain and against the length."""
        folded = fold(text)
        hits = self.hits(folded)
        n = max(folded.count(" ") - 1, 0)
        total = sum(hits)
        return (
            math.log1p(total),
            total / math.sqrt(n + 10.0),
            10.0 * len(hits) / (n + 10.0),
            math.log1p(n) if hits else 0.0,
            1.0 if hits else 0.0,
            1.0 if len(hits) > 1 else 0.0,
        )

    def score(self, text: str | None) -> float:
        if not self.curve:
            return 0.0
        z = self.curve[0] + sum(c * x for c, x in zip(self.curve[1:], self.features(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(folded: str) -> set[str]:
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in range(MIN_PREFIX, min(MAX_PREFIX, len(word) - 1) + 1))
    return out


def _evidence(a: float, b: float, na: float, nb: float) -> float:
    """Log-likelihood ratio of a term that a of na toxic and b of nb other texts have."""

    def part(k: float, n: float, p: float) -> float:
        out = k * math.log(p) if k else 0.0
        return out + ((n - k) * math.log1p(-p) if n > k else 0.0)

    p = (a + b) / (na + nb)
    if not 0 < p < 1 or a / na <= b / nb:
        return 0.0
    return 2 * (
        part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, p) - part(b, nb, p)
        if a < na or b
        else part(b, nb, 0.5)
    )


def _count(rows: DataFrame, make: Callable[[str], set[str]]) -> DataFrame:
    """Texts that have a term, toxic and other: summed in each task, then over all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            columns = [keys, [counts[1][k] for k in keys], [counts[0][k] for k in keys]]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
                ["term", "toxic", "other"],
            )

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(make(fold(text)))
                if len(counts[0]) + len(counts[1]) > 60_000:
                    yield out()
        yield out()

    partial = map_batches(
        rows.select("text", "label"), run, "term string, toxic long, other long"
    )
    return partial.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _phrases(lexicon: Lexicon) -> Callable[[str], set[str]]:
    """Pairs of neighbouring words in which an entry occurs."""
    single = Lexicon(lexicon.weights)

    def make(folded: str) -> set[str]:
        words, out = folded.split(), set()
        marked = [bool(single.hits(f" {w} ")) for w in words] if single.hits(folded) else []
        for k, mark in enumerate(marked):
            if mark:
                out.update(f" {a} {b} " for a, b in zip(words[max(0, k - 1) : k + 1],
                                                        words[max(0, k - 1) + 1 : k + 2]))
        return out

    return make


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Logistic curve by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(x), 1)), x])
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(beta))
    penalty[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta
        )
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(b) for b in beta)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    max_rows: int = 20_000,
    max_terms: int = 5_000,
    min_texts: int = 4,
    min_evidence: float = 16.0,
    given: Mapping[str, float] | None = None,
) -> Lexicon:
    """Learn a lexicon from labelled documents.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. ``learn`` is a
    condition over doc_id for the rows to learn from. Of the labelled ids the
    ``max_rows`` with the smallest hash are taken, a bounded sample that does
    not depend on partitioning; entries are chosen from two thirds of it and
    the curve is drawn over the rest. ``max_terms`` bounds the lexicon: the
    entries with the strongest evidence stay.
    """
    ids = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("label"))
    ids = ids.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
    if learn is not None:
        ids = ids.withColumnRenamed("id", "doc_id").filter(learn).withColumnRenamed("doc_id", "id")
    ids = ids.groupBy("id").agg(F.max("label").alias("label"))
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    doc_id, text = plain(docs, ["doc_id", "text"])
    # Bounded by max_rows rows of two numbers.
    rows = docs.select(doc_id.alias("id"), text.alias("text")).join(F.broadcast(chosen), "id")
    rows = written(rows.select("id", "text", "label"), "labelled")
    third = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(3))
    first, rest = rows.filter(third != 0), rows.filter(third == 0)

    sizes = {r["label"]: r["n"] for r in first.groupBy("label").agg(F.count("*").alias("n")).collect()}
    na, nb = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon(dict(given or {}))
    if na and nb:
        common = _count(first, _terms).filter(
            (F.col("toxic") >= min_texts) & (F.col("toxic") * nb > F.col("other") * na)
        )
        strength = F.log((F.col("toxic") + 0.5) / (na + 1)) - F.log((F.col("other") + 0.5) / (nb + 1))
        top = common.withColumn("w", strength).orderBy(
            (F.col("w") * F.col("toxic")).desc(), "term"
        ).limit(4 * max_terms)
        found = [(r["term"], r["toxic"], r["other"], r["w"]) for r in top.collect()]
        strong = [
            (t, w) for t, a, b, w in found if w > 1.0 and _evidence(a, b, na, nb) >= min_evidence
        ]
        lexicon.weights |= dict(strong[:max_terms])
        if lexicon.weights:
            phrases = _count(first, _phrases(lexicon)).filter(
                (F.col("other") >= min_texts) & (F.col("toxic") * nb < F.col("other") * na)
            )
            kept = phrases.orderBy(F.col("other").desc(), "term").limit(max_terms)
            lexicon.exceptions = [r["term"] for r in kept.collect()]
    seen = map_batches(
        rest.select("text", "label"), _feature_rows(lexicon), "label double, x array<double>"
    ).collect()
    y = np.array([r["label"] for r in seen])
    if len(y) and 0 < y.sum() < len(y):
        lexicon.curve = _logistic(np.array([r["x"] for r in seen]), y)
    elif len(y):
        lexicon.curve = (30.0 if y.all() else -30.0, *[0.0] * 6)
    return lexicon


def _feature_rows(lexicon: Lexicon) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(lexicon.features(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.float64()), pa.array(x, pa.list_(pa.float64()))],
                ["label", "x"],
            )

    return run


def score_column(
    frame: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score"
) -> DataFrame:
    """Add the score of a text column. The lexicon goes out as a broadcast, bounded by ``max_terms``."""
    name, at = free_name(frame, out), frame.columns.index(text)
    sent = frame.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = sent.value
        for batch in batches:
            scores = pa.array([lex.score(t) for t in batch.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores], [*batch.schema.names, name]
            )

    return map_batches(frame, run, T.StructType([*frame.schema.fields, T.StructField(name, T.DoubleType())]))


def keep_clean(
    frame: DataFrame, lexicon: Lexicon, threshold: float = 0.3, text: str = "text"
) -> DataFrame:
    """The rows that score below the threshold, with their columns as they were."""
    name = free_name(frame, "score")
    scored = score_column(frame, lexicon, text)
    return scored.filter(F.col(name) < threshold).drop(name)
