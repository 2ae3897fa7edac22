"""Language identification of words, spans and texts.

A model holds, for each language, how often it uses each hashed run of one to
three letters (word ends count as letters), and the scripts it is written in.
For a text, the script of each word, by ranges of code points, narrows the
candidates; the remaining languages are scored by the runs of the word; Viterbi
then labels the words of a text so that the sum of scores less a penalty for
each switch is greatest. Neighbouring words of one label make a span. The
language of a text is the one with most letters under its label.

The counts cover all rows given to ``fit``. Each task sums its rows in one
table of fixed size (languages x 2 ** bits), so what is shuffled grows with the
number of tasks and not with the text, and so does not what is broadcast.

Defined results: a text that is NULL or has no letter is ``und`` with score 0;
so is every text if nothing was learned. Rows with a NULL language or text are
not learned from. Ties go to the first language in order. Repeated rows each
get their result; extra columns are carried. Texts are labelled whole, in
blocks of texts with a bounded number of letters together.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import free_name, map_batches, plain

BITS = 15
MAX_LANGUAGES = 512
UNKNOWN = "und"
#: Letters of the texts labelled together.
_TOGETHER = 1_000_000

# First code point of a range and its script; 0 is any other.
_SCRIPTS = ["other", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari",
            "bengali", "tamil", "thai", "georgian", "hangul", "kana", "han"]
_RANGES = [
    (0x0000, 0), (0x0041, 1), (0x02B0, 0), (0x0370, 2), (0x0400, 3), (0x0530, 4), (0x0590, 5),
    (0x0600, 6), (0x0700, 0), (0x0750, 6), (0x0780, 0), (0x0900, 7), (0x0980, 8), (0x0A00, 0),
    (0x0B80, 9), (0x0C00, 0), (0x0E00, 10), (0x0E80, 0), (0x10A0, 11), (0x1100, 12), (0x1200, 0),
    (0x1E00, 1), (0x1F00, 2), (0x2000, 0), (0x3040, 13), (0x3100, 0), (0x3400, 14), (0xA000, 0),
    (0xAC00, 12), (0xD7B0, 0), (0xF900, 14), (0xFB00, 1), (0xFB07, 0), (0xFF21, 1), (0xFF5B, 0),
    (0x20000, 14), (0x32000, 0),
]


@cache
def _letter_table() -> np.ndarray:
    """Whether a code point is a letter or a mark within a word."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)])


def scripts_of(points: np.ndarray) -> np.ndarray:
    starts = np.array([r[0] for r in _RANGES])
    return np.array([r[1] for r in _RANGES])[np.searchsorted(starts, points, side="right") - 1]


@dataclass
class Words:
    """The letters of some texts in a row, with the word each belongs to."""

    letters: np.ndarray  # code points, 0 before and after each word
    text: np.ndarray  # text of each word
    first: np.ndarray  # place of each word's first letter
    length: np.ndarray  # its letters


def words_in(texts: list[str | None]) -> Words:
    """Split lower-case texts into runs of letters."""
    points = [
        np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        for t in texts
    ]
    sizes = np.array([len(p) + 1 for p in points])
    flat = np.zeros(sizes.sum() + 1, dtype=np.uint32)
    ends = np.cumsum(sizes)
    for p, end in zip(points, ends):
        flat[end - len(p) : end] = p
    is_letter = _letter_table()[flat]
    # A word begins with a letter; marks alone are no word.
    flat[~is_letter] = 0
    edge = np.diff(np.concatenate([[0], is_letter.astype(np.int8), [0]]))
    first = np.flatnonzero(edge == 1)
    last = np.flatnonzero(edge == -1)
    text = np.searchsorted(ends, first, side="right")
    return Words(flat, text, first, last - first)


_MUL = np.uint64(0x9E3779B97F4A7C15)


def grams(words: Words, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed runs of one to three letters around each place within a word.

    Returns a row of three hashes for each letter and one end of each word, and
    the word of each row.
    """
    x = words.letters.astype(np.uint64) + np.uint64(1)
    total = words.length + 1  # the place after the word closes it
    at = np.repeat(words.first - np.cumsum(total) + total, total) + np.arange(total.sum())
    word = np.repeat(np.arange(len(words.first)), total)
    # Place 0 of the flat letters is always a gap, so two places before exist for every word.
    one, two = x[at], x[at - 1]
    three = x[np.maximum(at - 2, 0)]
    # Not beyond the gap before the word.
    three = np.where(two == 1, np.uint64(1), three)
    out = np.empty((len(at), 3), dtype=np.int64)
    mixed = one * _MUL
    shift = np.uint64(64 - bits)
    out[:, 0] = (mixed >> shift).astype(np.int64)
    mixed = ((mixed ^ (mixed >> np.uint64(29))) + two) * _MUL
    out[:, 1] = (mixed >> shift).astype(np.int64)
    mixed = ((mixed ^ (mixed >> np.uint64(29))) + three) * _MUL
    out[:, 2] = (mixed >> shift).astype(np.int64)
    return out, word


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    bits: int = BITS
    logs: np.ndarray | None = None  # 2 ** bits x languages
    uses: np.ndarray | None = None  # scripts x languages
    penalty: float = 6.0

    def word_scores(self, words: Words) -> np.ndarray:
        """A row of scores for each word; excluded languages are far below."""
        hashed, word = grams(words, self.bits)
        n = len(self.languages)
        scores = np.zeros((len(words.first), n), dtype=np.float64)
        for k in range(n):
            column = np.ascontiguousarray(self.logs[:, k])
            each = column[hashed[:, 0]] + column[hashed[:, 1]] + column[hashed[:, 2]]
            scores[:, k] = np.bincount(word, weights=each, minlength=len(words.first))
        allowed = self.uses[scripts_of(words.letters[words.first])]
        allowed[~allowed.any(axis=1)] = True
        scores[~allowed] -= 1e6
        return scores

    def label(self, words: Words) -> np.ndarray:
        """Viterbi over the words of each text, all texts together, longest first."""
        scores = self.word_scores(words)
        starts = np.flatnonzero(np.diff(words.text, prepend=-1))
        lengths = np.diff(np.append(starts, len(words.text)))
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        alive_at = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1 if len(lengths) else 1),
                                   side="right")
        back = np.zeros(scores.shape, dtype=np.int16)
        labels = np.zeros(len(scores), dtype=np.int16)
        own = np.arange(len(self.languages), dtype=np.int16)
        value = scores[starts].copy()
        for t in range(1, int(lengths[0]) if len(lengths) else 0):
            alive = int(alive_at[t])
            at = starts[:alive] + t
            before = value[:alive]
            best = before.argmax(axis=1)
            reach = before[np.arange(alive), best] - self.penalty
            stay = before >= reach[:, None]
            back[at] = np.where(stay, own, best[:, None])
            value[:alive] = np.where(stay, before, reach[:, None]) + scores[at]
        last = value.argmax(axis=1).astype(np.int16)
        for t in range(int(lengths[0]) - 1 if len(lengths) else -1, -1, -1):
            alive = int(alive_at[t])
            at = starts[:alive] + t
            labels[at] = last[:alive]
            last[:alive] = back[at, last[:alive]]
        return labels

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float], list[list[tuple]]]:
        """Language, score and spans ``(language, words, letters)`` of each text."""
        found, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        spans: list[list[tuple]] = [[] for _ in texts]
        words = words_in(texts)
        if not self.languages or not len(words.first):
            return found, score, spans
        labels = self.label(words)
        n = len(self.languages)
        share = np.zeros((len(texts), n))
        np.add.at(share, (words.text, labels), words.length)
        totals = share.sum(axis=1)
        best = share.argmax(axis=1)
        for k in np.flatnonzero(totals).tolist():
            found[k] = self.languages[best[k]]
            score[k] = float(share[k, best[k]] / totals[k])
        cut = np.flatnonzero((np.diff(words.text, prepend=-1) != 0) | (np.diff(labels, prepend=-1) != 0))
        letters = np.add.reduceat(words.length, cut)
        counts = np.diff(np.append(cut, len(labels)))
        for c, n_words, n_letters in zip(cut.tolist(), counts.tolist(), letters.tolist()):
            spans[words.text[c]].append((self.languages[labels[c]], n_words, n_letters))
        return found, score, spans


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """Texts in order, few enough to be labelled together; a long one alone."""
    lo, size = 0, 0
    for k, text in enumerate(texts):
        n = len(text or "")
        if k > lo and size + n > _TOGETHER:
            yield lo, texts[lo:k]
            lo, size = k, 0
        size += n
    yield lo, texts[lo:]


def fit(
    rows: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS, penalty: float = 6.0
) -> Model:
    """Count the letter runs and scripts of every language over all rows."""
    body, name = plain(rows, [text, lang])
    known = rows.select(body.alias("text"), name.alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL"
    )
    size, n_scripts = 1 << bits, len(_SCRIPTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = (c.to_pylist() for c in batch.columns)
            for lo, part in _blocks(texts):
                words = words_in(part)
                if not len(words.first):
                    continue
                hashed, word = grams(words, bits)
                names, number = np.unique(langs[lo : lo + len(part)], return_inverse=True)
                of_word = number[words.text]
                script = scripts_of(words.letters[words.first])
                for k, one in enumerate(names.tolist()):
                    if one not in sums:
                        sums[one] = np.zeros(size + n_scripts, dtype=np.int64)
                    mine = of_word == k
                    sums[one][:size] += np.bincount(hashed[mine[word]].ravel(), minlength=size)
                    sums[one][size:] += np.bincount(script[mine], minlength=n_scripts)
        for one, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([one] * len(at)), pa.array(at), pa.array(counts[at])],
                ["lang", "slot", "n"],
            )

    counts = map_batches(known, run, "lang string, slot long, n long")
    counts = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    # Not more rows than languages times table size, whatever the corpus.
    found = counts.toPandas()
    model = Model(sorted(found["lang"].unique().tolist()), bits, penalty=penalty)
    if len(model.languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: is the column one of languages?")
    n = len(model.languages)
    table = np.zeros((size + n_scripts, max(n, 1)))
    column = found["lang"].map({x: k for k, x in enumerate(model.languages)})
    table[found["slot"].to_numpy(dtype=np.int64), column.to_numpy(dtype=np.int64)] = found["n"]
    runs, scripts = table[:size], table[size:]
    smooth = (runs + 0.5) / (runs.sum(axis=0) + 0.5 * size)
    model.logs = np.log(smooth).astype(np.float32)
    model.uses = scripts > 0.002 * np.maximum(scripts.sum(axis=0), 1)
    return model


def _labelled(frame: DataFrame, model: Model, text: str, fields: list, make: Callable) -> DataFrame:
    at = frame.columns.index(text)
    sent = frame.sparkSession.sparkContext.broadcast(model)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, part in _blocks(texts):
                new = make(*sent.value.texts(part))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, len(part)).columns, *new], [*batch.schema.names, *names]
                )

    return map_batches(frame, run, T.StructType([*frame.schema.fields, *fields]))


def language_columns(frame: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the share of letters in that language."""
    fields = [
        T.StructField(free_name(frame, "lang_pred"), T.StringType()),
        T.StructField(free_name(frame, "score"), T.DoubleType()),
    ]
    return _labelled(
        frame, model, text, fields,
        lambda found, score, _: [pa.array(found, pa.string()), pa.array(score, pa.float64())],
    )


def span_column(frame: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``spans``: language, number of words and of letters of each span, in order."""
    span = T.StructType(
        [
            T.StructField("lang", T.StringType()),
            T.StructField("n_words", T.IntegerType()),
            T.StructField("n_letters", T.IntegerType()),
        ]
    )
    kind = pa.list_(
        pa.struct([("lang", pa.string()), ("n_words", pa.int32()), ("n_letters", pa.int32())])
    )

    def make(_, __, spans: list[list[tuple]]) -> list[pa.Array]:
        names = ("lang", "n_words", "n_letters")
        return [pa.array([[dict(zip(names, s)) for s in row] for row in spans], kind)]

    fields = [T.StructField(free_name(frame, "spans"), T.ArrayType(span))]
    return _labelled(frame, model, text, fields, make)
