"""Periodic runs of words: stretches that repeat one block three times or more.

A run is a stretch of consecutive words whose smallest period is ``q`` (words
``q`` apart are equal), at least ``max(MIN_WORDS, MIN_TIMES * q)`` words long,
that neither neighbouring word extends. Texts of a batch are laid out in one
array of word codes, longest first, with a code of its own after each text, so
that every step below is a few array operations for the whole batch.

* **Direct lag scans** find periods up to ``SHORT``: for each lag the places
  where a word differs from the one a lag further; long gaps between them are runs.
* **Multi-scale minimizers** find the rest. The scale for periods from ``p`` to
  ``K = 8/5 p`` hashes every ``K`` words and keeps the smallest hash of each
  window of ``2p + 1 - K`` places. A run of period ``q`` in that range holds a
  window and the same window ``q`` further, whose minima are equal. Any ``K >= q``
  words occur once in a period, so the next place with the same minimum is
  exactly ``q`` away. Each pair of neighbouring equal minima at a distance of this
  scale seeds an extension to both sides, which compares the words themselves.
  A seed is two equal, touching blocks, so seeds are never chance agreements.

A scale only looks at texts long enough for its shortest period. Stretches found
with a multiple of their period have the ends of the run itself; the smallest
period stays.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: a NULL or empty text has no
words, no runs and an empty collapsed text; repeated rows each get their result;
other columns are carried, whatever their names; an empty table gives an empty
one. A text is searched whole; memory is some hundred bytes per word of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fundflow.llm.common import byte_slices, free_name, map_batches, split_words

MIN_WORDS = 24
MIN_TIMES = 3
#: The longest period that lag scans look for.
SHORT = 16
#: Bytes of text searched at a time.
BATCH_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_TOO = np.uint64(0xC2B2AE3D27D4EB4F)


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two neighbouring blocks from the hashes of each."""
    mixed = left * _ODD
    mixed ^= mixed >> np.uint64(32)
    mixed += right
    mixed *= _ODD_TOO
    mixed ^= mixed >> np.uint64(29)
    return mixed


def _sliding(values: np.ndarray, width: int, smaller: np.ufunc) -> np.ndarray:
    """``smaller`` over every window of ``width`` values, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = smaller(values[:-step], values[step:])
        done += step
    return values


@dataclass(frozen=True)
class Scale:
    """Periods from ``first`` to ``block``, found by minima of ``window`` blocks."""

    first: int
    block: int
    window: int


def scales(longest: int) -> Iterator[Scale]:
    """Scales for all periods above ``SHORT`` that a text of so many words can hold three times."""
    first = SHORT + 1
    while MIN_TIMES * first <= longest:
        block = first * 8 // 5
        yield Scale(first, block, 2 * first + 1 - block)
        first = block + 1


def _by_lags(codes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    found = []
    longest = int(lengths.max(initial=0))
    for lag in range(1, min(SHORT, longest // MIN_TIMES) + 1):
        differs = np.flatnonzero(codes[:-lag] != codes[lag:])
        # The code after each text is unlike all others, so the ends of the array differ as well.
        before = np.concatenate(([-1], differs))
        gaps = np.diff(np.concatenate((before, [len(codes) - lag]))) - 1
        hits = np.flatnonzero(gaps >= max(MIN_WORDS, MIN_TIMES * lag) - lag)
        start = before[hits] + 1
        found.append(np.stack([start, start + gaps[hits] + lag, np.full(len(hits), lag)], axis=1))
    return found


def _seeds(hashes: np.ndarray, scale: Scale) -> tuple[np.ndarray, np.ndarray]:
    """Places of minima and the distance to the next equal one, by distance, then place."""
    least = _sliding(hashes, scale.window, np.minimum)
    edge = np.zeros(scale.window - 1, np.uint64)
    # A place is a minimum of some window if the largest minimum of its windows is its own.
    most = _sliding(np.concatenate((edge, least, edge)), scale.window, np.maximum)
    kept = np.flatnonzero(most == hashes)
    values = hashes[kept]
    order = np.argsort(values, kind="stable")
    kept, values = kept[order], values[order]
    apart = np.diff(kept)
    pairs = np.flatnonzero(
        (values[1:] == values[:-1]) & (apart >= scale.first) & (apart <= scale.block)
    )
    places, lags = kept[pairs], apart[pairs]
    order = np.lexsort((places, lags))
    return places[order], lags[order]


def _agree(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal those a lag further."""
    total, size = 0, 64
    while True:
        if step > 0:
            lo = at + total
            hi = min(lo + size, len(codes) - lag)
            differs = codes[lo:hi] != codes[lo + lag : hi + lag]
        else:
            hi = at - total + 1
            lo = max(hi - size, 0)
            differs = (codes[lo:hi] != codes[lo + lag : hi + lag])[::-1]
        if differs.any():
            return total + int(differs.argmax())
        total += len(differs)
        if len(differs) < size:
            return total
        size *= 2


def _by_minimizers(codes: np.ndarray, lengths: np.ndarray) -> list[list[tuple]]:
    found: list[list[tuple]] = []
    hashes, width = codes.astype(np.uint64), 1
    hashes = _join(hashes, hashes)
    ends = np.cumsum(lengths + 1)
    for scale in scales(int(lengths.max(initial=0))):
        # Texts are in order of their length, longest first.
        texts = int(np.searchsorted(-lengths, -MIN_TIMES * scale.first, side="right"))
        hashes = hashes[: int(ends[texts - 1]) - width + 1]
        while 2 * width <= scale.block:
            hashes = _join(hashes[:-width], hashes[width:])
            width *= 2
        rest = scale.block - width
        blocks = _join(hashes[:-rest], hashes[rest:]) if rest else hashes
        if len(blocks) < scale.window:
            continue
        runs: list[tuple] = []
        last_lag, until = 0, -1
        for place, lag in zip(*(x.tolist() for x in _seeds(blocks, scale))):
            if lag == last_lag and place < until:
                continue  # within the stretch found last
            right = _agree(codes, place, lag, 1)
            start = place - _agree(codes, place - 1, lag, -1) if place else 0
            last_lag, until = lag, place + right
            end = until + lag
            if end - start >= max(MIN_WORDS, MIN_TIMES * lag):
                runs.append((start, end, lag))
        found.append(runs)
    return found


def find_runs(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows ``(text, start, length, period)`` by text, start and period.

    ``codes`` holds the texts one after the other, longest first, each followed by
    a code that occurs nowhere else; ``lengths`` are their numbers of words.
    """
    parts = [*_by_lags(codes, lengths), *_by_minimizers(codes, lengths)]
    parts = [np.asarray(p, np.int64).reshape(-1, 3) for p in parts if len(p)]
    if not parts:
        return np.empty((0, 4), np.int64)
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))
    text = np.searchsorted(begins, rows[:, 0], side="right") - 1
    out = np.stack([text, rows[:, 0] - begins[text], rows[:, 1] - rows[:, 0], rows[:, 2]], axis=1)
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def runs_of_texts(texts: pa.Array) -> tuple[list[np.ndarray], list[str], np.ndarray]:
    """For each text its runs ``(start, length, period)``, its collapsed text, its number of words."""
    flat, counts = split_words(texts)
    begins = np.concatenate(([0], np.cumsum(counts)))
    longest_first = np.argsort(-counts, kind="stable")
    lengths = counts[longest_first]
    encoded = flat.dictionary_encode()
    coded = encoded.indices.to_numpy(zero_copy_only=False)
    known = len(encoded.dictionary)
    codes = np.empty(len(coded) + len(counts), np.int64)
    at = 0
    for k, text in enumerate(longest_first.tolist()):
        n = int(counts[text])
        codes[at : at + n] = coded[begins[text] : begins[text] + n]
        codes[at + n] = known + k
        at += n + 1
    rows = find_runs(codes, lengths)
    bounds = np.searchsorted(rows[:, 0], np.arange(len(counts) + 1))
    of_text = np.empty(len(counts), np.int64)
    of_text[longest_first] = np.arange(len(counts))
    found = [rows[bounds[k] : bounds[k + 1], 1:] for k in of_text.tolist()]
    joined = pc.binary_join(pa.ListArray.from_arrays(begins.astype(np.int32), flat), " ").to_pylist()
    for k, runs in enumerate(found):
        if len(runs):
            kept = np.ones(int(counts[k]), bool)
            for start, length, period in runs.tolist():
                kept[start + period : start + length] = False
            mine = flat.slice(int(begins[k]), int(counts[k])).filter(pa.array(kept))
            joined[k] = " ".join(mine.to_pylist())
    return found, joined, counts


_SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_SPAN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def _span(run: list[int]) -> dict[str, int]:
    return dict(zip(("start", "length", "period"), run))


def strongest(runs: list[list[int]]) -> list[int] | None:
    """The run with the greatest length per period; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def run_columns(frame: DataFrame, text: str = "text") -> DataFrame:
    """Replace a text column by ``n_words``, ``runs``, ``strongest`` and ``collapsed``.

    ``runs`` is an array of ``(start, length, period)`` by start, then period;
    ``strongest`` the one of them with most repetitions, or NULL. ``collapsed``
    are the words that stay when of every run only the first period is kept,
    joined by a blank. Columns get other names where the frame has those already.
    """
    at = frame.columns.index(text)
    kept = [k for k in range(len(frame.columns)) if k != at]
    fields = [
        T.StructField(free_name(frame, "n_words"), T.LongType()),
        T.StructField(free_name(frame, "runs"), T.ArrayType(_SPAN)),
        T.StructField(free_name(frame, "strongest"), _SPAN),
        T.StructField(free_name(frame, "collapsed"), T.StringType()),
    ]
    schema = T.StructType([frame.schema.fields[k] for k in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, at, BATCH_BYTES):
            found, joined, counts = runs_of_texts(batch.column(at))
            spans = [r.tolist() for r in found]
            best = [strongest(r) for r in spans]
            new = [
                pa.array(counts, pa.int64()),
                pa.array([[_span(x) for x in r] for r in spans], pa.list_(_ARROW_SPAN)),
                pa.array([b and _span(b) for b in best], _ARROW_SPAN),
                pa.array(joined, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in kept], *new], schema.names)

    # Numbered names, as columns may be called anything.
    numbered = frame.toDF(*[f"c{k}" for k in range(len(frame.columns))])
    return map_batches(numbered, run, schema, rows=None)
