"""Token ids of whole texts by the tokenizers library, each distinct word encoded once.

A tokenizer whose file cuts texts at blanks and never joins across them encodes a
text as the concatenation of its blank-separated words. Words of a batch are
reduced to the distinct ones, looked up in a table that a Python worker keeps,
and only unknown ones go to the library. The table has two generations, so its
size is bounded; every word that was dropped is simply encoded again. Files of any
other shape are encoded text by text.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from fundflow.llm.common import split_words

#: Words in one generation of a worker's table, and the longest of them.
TABLE_WORDS = 250_000
WORD_LENGTH = 64
#: Ids put together at a time.
_PIECE_WORDS = 1 << 19
# The steps of a tokenizer file that never looks across blanks.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word of its own, put between words that are encoded together.
_BETWEEN = "|"
#: Signs cut off the end of a word before it is looked up: no apostrophe, which can begin a piece.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"
# Digits and Latin letters but for one, whose small letter ends in a mark.
_ENDS_PLAINLY = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]$"
#: Below are the Latin letters, whose kind no version of Unicode has changed.
_LATIN_END = "\u0250"
# Marks that may compose with a capital letter but not with the small one, or the other way.
_COMBINING = "[\u0300-\u036f]"


def cuts_at_blanks(spec: dict) -> bool:
    """Whether a tokenizer file is known to encode word by word."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
        and steps[0].get("type") == "Split"
        and steps[0].get("pattern") == {"Regex": _CUT}
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert") is True
        and [s.get("type") for s in steps[1:]] == ["ByteLevel"]
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
        and not any(t.get("lstrip") or t.get("rstrip") for t in spec["added_tokens"])
        and not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
    )


class WordTable:
    """Encodes batches of texts with one tokenizer file."""

    def __init__(self, file_text: str, table_words: int = TABLE_WORDS):
        spec = json.loads(file_text)
        self.tokenizer = Tokenizer.from_str(file_text)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table_words = table_words
        self.by_words = cuts_at_blanks(spec)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._pieces = Tokenizer(self.tokenizer.model)
        self._pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        suffix = (spec["model"].get("end_of_word_suffix") or "\0") if self.by_words else "\0"
        self._last = np.zeros(self.size, bool)
        for label, token in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self._last[token] = label.endswith(suffix)
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self._between = between[0] if len(between) == 1 else None

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _cut(self, ids: list[int], ends: np.ndarray, skip: int) -> list[bytes]:
        """The ids cut at ``ends``, leaving out ``skip`` ids after each cut."""
        data, width = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize
        starts = np.concatenate(([0], ends[:-1] + skip)) * width
        return [data[a:b] for a, b in zip(starts.tolist(), (ends * width).tolist())]

    def _letters_only(self, words: list[str]) -> list[bytes]:
        """Ids of words of small Latin letters, in one call; each is one piece with one last id."""
        [found] = self._pieces.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ends = np.flatnonzero(self._last[np.array(found.ids, np.int64)]) + 1
        return self._cut(found.ids, ends, 0) if len(ends) == len(words) else self._library(words)

    def _other(self, words: list[str]) -> list[bytes]:
        """Ids of any words, in one call, cut at a word put between them."""
        if self._between is None or len(words) < 2:
            return self._library(words)
        joined = f" {_BETWEEN} ".join(words)
        [found] = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)
        ends = np.append(np.flatnonzero(np.array(found.ids) == self._between), len(found.ids))
        return self._cut(found.ids, ends, 1) if len(ends) == len(words) else self._library(words)

    def _new_words(self, words: list[str]) -> list[bytes]:
        """Ids of unknown words."""
        kinds = [
            0 if w.isalpha() and max(w) < _LATIN_END and w == w.lower() else 2 if _BETWEEN in w else 1
            for w in words
        ]
        ways = (self._letters_only, self._other, self._library)
        found = [
            iter(way([w for w, k in zip(words, kinds) if k == kind]) if kind in kinds else ())
            for kind, way in enumerate(ways)
        ]
        return [next(found[kind]) for kind in kinds]

    def _parts(self, words: pa.Array) -> pa.Array:
        """Each word as two: itself without the signs at its end, and these signs.

        Signs after a Latin letter or a digit are a piece of their own; other words
        stay whole, with an empty second part.
        """
        stems = pc.utf8_rtrim(words, characters=_SIGNS)
        cut = pc.match_substring_regex(stems, _ENDS_PLAINLY)
        for special in self.special:
            cut = pc.and_not(cut, pc.match_substring(words, special))
        lengths = pc.binary_length(pc.if_else(cut, stems, words)).to_numpy(zero_copy_only=False)
        offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1]
        between = np.empty(2 * len(words) + 1, np.int32)
        between[::2] = offsets
        between[1::2] = offsets[:-1] + lengths
        buffers = [None, pa.py_buffer(between), words.buffers()[2]]
        return pa.Array.from_buffers(pa.string(), 2 * len(words), buffers)

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        found = list(map(self._young.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if missing:
            young, old = self._young, self._old
            unknown = []
            for k in missing:
                ids = found[k] = old.get(words[k])
                if ids is None:
                    unknown.append(k)
            for k, ids in zip(unknown, self._new_words([words[k] for k in unknown])):
                found[k] = ids
            young.update((words[k], found[k]) for k in missing if len(words[k]) <= WORD_LENGTH)
            if len(young) > self.table_words:
                self._young, self._old = {}, young
        return found

    def _lowered(self, texts: pa.Array) -> pa.Array:
        """Texts with small ASCII letters where that changes no id; it saves words in the table."""
        lower = pc.ascii_lower(texts)
        keep = pc.match_substring_regex(texts, _COMBINING)
        for special in self.special:
            keep = pc.or_(keep, pc.match_substring(lower, special.lower()))
        return pc.if_else(keep, texts, lower)

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the number of ids of each text.

        ``end`` is an id put after each text. A NULL text is an empty one.
        """
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.by_words:
            ids, counts = self._by_words(self._lowered(texts))
        else:
            found = self._library(texts.to_pylist())
            ids = np.frombuffer(b"".join(found), self.dtype)
            counts = np.array([len(x) // self.dtype.itemsize for x in found], np.int64)
        if end is not None:
            ids = np.insert(ids, np.cumsum(counts), end)
            counts = counts + 1
        return ids, counts

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, words = split_words(texts)
        encoded = flat.dictionary_encode()
        which = encoded.indices.to_numpy(zero_copy_only=False)
        if not len(encoded.dictionary):
            return np.empty(0, self.dtype), words
        parts = self._parts(encoded.dictionary).dictionary_encode()
        known = self._ids_of_words(parts.dictionary.to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.dtype.itemsize
        store = np.frombuffer(b"".join(known), self.dtype)
        halves = parts.indices.to_numpy(zero_copy_only=False)
        store = self._gather(store, sizes, halves)
        sizes = sizes[halves].reshape(-1, 2).sum(axis=1)
        ids = self._gather(store, sizes, which)
        ends = np.concatenate(([0], np.cumsum(sizes[which])))
        bounds = np.concatenate(([0], np.cumsum(words)))
        return ids, np.diff(ends[bounds])

    def _gather(self, store: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The ids of the chosen entries of a store, one entry after the other."""
        starts = np.cumsum(sizes) - sizes
        pieces: list[np.ndarray] = []
        for lo in range(0, len(which), _PIECE_WORDS):
            part = which[lo : lo + _PIECE_WORDS]
            lengths = sizes[part]
            shift = starts[part] - (np.cumsum(lengths) - lengths)
            pieces.append(store[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))])
        return np.concatenate(pieces) if pieces else np.empty(0, self.dtype)


_TABLES: dict[int, WordTable] = {}


def table_of(file_text: str) -> WordTable:
    """The table of this worker for a tokenizer file; kept from task to task."""
    key = hash(file_text)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = WordTable(file_text)
    return _TABLES[key]


def binary_rows(values: np.ndarray, counts: Iterable[int]) -> pa.Array:
    """The values cut into rows of so many each, as binary; no copy."""
    ends = np.concatenate(([0], np.cumsum(counts))) * values.dtype.itemsize
    offsets = pa.py_buffer(ends.astype(np.int32))
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(values))]
    )
