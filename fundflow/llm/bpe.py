"""Byte-pair encoding by an automaton over tokens.

The merges are compiled into a deterministic automaton, one merge gadget after
the other. Its states stand for the token read last; an arc labelled ``t`` from
a state says that ``t`` may follow. At first every symbol may follow every
symbol. The gadget of the merge ``(u, v) -> w``

* takes the arc ``v`` from the state of ``u`` (the pair is merged from now on),
* gives every state that has the arc ``u`` an arc ``w``, and
* lets ``w`` lead where ``v`` led before, so ``w`` starts with the arcs that ``v`` has now.

All arcs with one label lead to one state, so a state is a chain of owners: the
arcs that were taken from ``w`` itself, then those that had been taken from its
right half when ``w`` was made, and so on. An arc for ``w`` exists where the arc
for its left half existed when ``w`` was made. Asking for an arc walks these two
short chains; answers are kept in a table.

A word has exactly one token sequence whose neighbours are all joined by arcs:
its encoding. Reading from the left, each prefix has one last token, so a word
is encoded by table look-ups in one pass, without a queue of merges. Decoding
emits the labels of the arcs.

Defined results: a NULL or empty text has no tokens; the strings of special
tokens in a text become those tokens; repeated rows each get their result;
extra columns are carried. Texts of any length are encoded whole, in memory
proportional to one text; the word table is bounded.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Regex, normalizers, pre_tokenizers

from fundflow.llm.common import free_name, map_batches

_NEVER = 1 << 60
_WORD_END = "</w>"
# The pattern of the tokenizer file, with white space spelled out.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^{space}{L}{N}]+"
# The same for lower-case ASCII.
_ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_SPLIT = regex.compile(rf"[{_SPACE}]+")
# Blank for str.split but not for the tokenizer.
_CONTROLS = regex.compile("[\x1c-\x1f]")
#: Words kept in the table of one worker, and the longest of them.
WORD_TABLE = 60_000
WORD_LENGTH = 48
#: Answers of the automaton kept in its table.
ARC_TABLE = 150_000


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself where printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in shown)
    moved = {b: 256 + n for n, b in enumerate(rest)}
    return [chr(moved.get(b, b)) for b in range(256)]


_EVERY = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


def _runs_of(pattern: str) -> list[tuple[int, int]]:
    """First and last code points of all runs that the tokenizers library takes for a class."""
    cut = pre_tokenizers.Split(Regex(f"{pattern}+"), behavior="removed", invert=True)
    return [(ord(run[0]), ord(run[-1])) for run, _ in cut.pre_tokenize_str(_EVERY)]


@cache
def class_ranges(kind: str) -> str:
    """Ranges of the code points of a general category, by the library's own Unicode tables.

    Other tables are of other versions, in which other code points are assigned.
    """
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in _runs_of(rf"\p{{{kind}}}"))


# The library's own steps, for texts with code points that Python does not know.
_NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])


@cache
def newer_ranges() -> str:
    """Code points that the library knows, by its classes or its letter case, and Python does not."""
    unknown = [c for c in _EVERY if unicodedata.category(c) == "Cn"]
    known = {c for a, b in _runs_of(r"\P{Cn}") for c in range(a, b + 1)}
    forms = _NORMAL.normalize_str("\n".join(unknown)).split("\n")
    found = [ord(c) for c, form in zip(unknown, forms) if form != c or ord(c) in known]
    starts = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -2]) if c + 1 != after]
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in zip(starts, ends))


@dataclass
class TokenAutomaton:
    """States and arcs, compiled from an ordered list of merges."""

    labels: list[str]
    halves: dict[int, tuple[int, int]]  # token: its two halves
    born: dict[int, int]  # token: number of its merge, -1 for symbols
    merged: dict[tuple[int, int], int] = field(default_factory=dict)  # (owner, arc): when taken
    live: set[int] = field(default_factory=set)  # tokens that have arcs
    table: dict[int, bool] = field(default_factory=dict, repr=False)

    @classmethod
    def compile(cls, vocab: dict[str, int], merges: Iterable[tuple[str, str]]) -> TokenAutomaton:
        labels = [""] * (max(vocab.values(), default=-1) + 1)
        for label, token in vocab.items():
            labels[token] = label
        made = cls(labels, {}, {})
        made.live.update(vocab.values())
        pairs = []
        for left, right in merges:
            u, v = vocab[left], vocab[right]
            joined = left + right
            pairs.append((u, v, vocab[joined]))
            made.live.discard(vocab[joined])
        made.born = dict.fromkeys(made.live, -1)
        for when, (u, v, w) in enumerate(pairs):
            made._gadget(when, u, v, w)
        return made

    def _gadget(self, when: int, u: int, v: int, w: int) -> None:
        if u not in self.live or v not in self.live or not self._follows(u, v):
            return  # the path u, v does not exist any more
        self.merged[u, v] = when
        self.halves[w] = (u, v)
        self.born[w] = when
        self.live.add(w)

    def _owners(self, token: int) -> list[tuple[int, int]]:
        """Whose taken arcs the state of a token lacks, each with the time until which they count."""
        chain, until = [], _NEVER
        while True:
            chain.append((token, until))
            if token not in self.halves:
                return chain
            until = self.born[token]
            token = self.halves[token][1]

    def _makers(self, token: int) -> list[tuple[int, int]]:
        """The arcs an arc was made from, each with the time up to which it had to be there."""
        chain, until = [], _NEVER
        while True:
            chain.append((token, until))
            if token not in self.halves:
                return chain
            until = self.born[token] + 1
            token = self.halves[token][0]

    def _follows(self, state: int, token: int) -> bool:
        makers = self._makers(token)
        for owner, known in self._owners(state):
            for arc, needed in makers:
                when = self.merged.get((owner, arc))
                if when is not None and when < known and when < needed:
                    return False
        return True

    def follows(self, state: int, token: int) -> bool:
        """Whether the state of one token has an arc for another."""
        key = state << 24 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > ARC_TABLE:
                self.table.clear()
            known = self.table[key] = self._follows(state, token)
        return known


class Tokenizer:
    """Encoder and decoder of a word-level BPE file (lower case, white space dropped, word ends)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        if model["end_of_word_suffix"] != _WORD_END or spec["decoder"] is not None:
            raise ValueError("not a word-end BPE file without a decoder")
        vocab = model["vocab"]
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.automaton = TokenAutomaton.compile(vocab, merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = self.automaton.labels + [""] * (
            max([len(self.automaton.labels) - 1, *self.special.values()])
            + 1
            - len(self.automaton.labels)
        )
        for label, token in self.special.items():
            self.labels[token] = label
        self.inner, self.final = {}, {}
        for label, token in vocab.items():
            if token in self.automaton.live and token not in self.special.values():
                if label.endswith(_WORD_END) and label != _WORD_END:
                    self.final[label.removesuffix(_WORD_END)] = token
                else:
                    self.inner[label] = token
        self.longest = max(map(len, [*self.inner, *self.final]), default=0)
        self.decimals = [str(n) for n in range(len(self.labels))]
        self._letters = byte_letters()
        classes = {"L": class_ranges("L"), "N": class_ranges("N"), "space": _SPACE}
        self._pieces = regex.compile(_PIECES.format(**classes))
        newer = newer_ranges() or r"\U0010ffff"
        self._newer = re.compile(f"[{newer}]")
        # One range, which is looked for much faster; most texts have nothing beyond it.
        self._high = re.compile(rf"[{newer[:10]}-\U0010ffff]")
        self._cut = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self._words: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._root: dict | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": {}, "_old": {}, "_root": None}

    def _tree(self) -> dict:
        """The labels letter by letter; at "" the token that ends here, at _WORD_END a word's last."""
        root: dict = {}
        for tokens, mark in ((self.inner, ""), (self.final, _WORD_END)):
            for label, token in tokens.items():
                node = root
                for letter in label:
                    node = node.setdefault(letter, {})
                node[mark] = token
        return root

    def word(self, letters: str) -> list[int]:
        """Tokens of one word, given in byte letters.

        Follows the longest arc first. A prefix has only one encoding, so a place
        from which no arc leads on is left for good: a word costs a bounded
        number of look-ups per letter.
        """
        if self._root is None:
            self._root = self._tree()
        root, table, n, longest = self._root, self.automaton.table, len(letters), self.longest
        out: list[int] = []
        ends = [0]
        left: set[int] = set()
        at = 0
        while at < n:
            node, choices, end = root, [], at
            for letter in letters[at : at + longest]:
                node = node.get(letter)
                if node is None:
                    break
                end += 1
                token = node.get("" if end < n else _WORD_END)
                if token is not None:
                    choices.append((end, token))
            while choices:
                end, token = choices.pop()
                if end in left:
                    continue
                if at:
                    leads = table.get(out[-1] << 24 | token)
                    if leads is None:
                        leads = self.automaton.follows(out[-1], token)
                    if not leads:
                        continue
                out.append(token)
                ends.append(end)
                at = end
                break
            else:
                left.add(at)
                out.pop()
                ends.pop()
                at = ends[-1]
        return out

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Tokens of a run without white space, kept in the word table unless it is long.

        The table has two generations: when the young one is full it becomes the
        old one, and what is asked for again comes back from there.
        """
        known = self._words.get(chunk)
        if known is not None:
            return known
        known = self._old.get(chunk)
        if known is None:
            if chunk.isalpha():
                if not chunk.isascii():
                    letters = self._letters
                    ids = self.word("".join([letters[b] for b in chunk.encode("utf-8")]))
                else:
                    ids = self.word(chunk)
            elif len(pieces := self._cut_up(chunk)) > 1:
                ids = [t for piece in pieces for t in self._chunk(piece)]
            elif pieces:
                letters = self._letters
                ids = self.word("".join([letters[b] for b in pieces[0].encode("utf-8")]))
            else:
                ids = []
            known = tuple(ids)
        if len(chunk) <= WORD_LENGTH:
            if len(self._words) >= WORD_TABLE:
                self._words, self._old = {}, self._words
            self._words[chunk] = known
        return known

    def _cut_up(self, chunk: str) -> list[str]:
        return (_ASCII_PIECES if chunk.isascii() else self._pieces).findall(chunk)

    def _plain(self, text: str, ids: list[int]) -> None:
        if text.isascii():
            text = text.lower()
        elif self._high.search(text) and self._newer.search(text):
            text = _NORMAL.normalize_str(text)
        else:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        for chunk in _SPLIT.split(text) if _CONTROLS.search(text) else text.split():
            ids += self._chunk(chunk)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        text, done = text or "", 0
        for found in self._cut.finditer(text):
            self._plain(text[done : found.start()], ids)
            ids.append(self.special[found.group()])
            done = found.end()
        self._plain(text[done:], ids)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.labels.__getitem__, ids))

    def decimal(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.decimals.__getitem__, ids))


def load(path: str) -> Tokenizer:
    """Compile a tokenizer file that the driver can read."""
    with open(path, encoding="utf-8") as file:
        return Tokenizer(file.read())


def _added(
    frame: DataFrame, tokenizer: Tokenizer, text: str, fields: list, make, keep: bool = True
) -> DataFrame:
    """The frame with columns that ``make(tokenizer, text)`` gives, one tuple per row.

    Without ``keep`` the text itself does not come back.

    The automaton goes out as a broadcast; its size is that of the tokenizer
    file (some MB) and does not depend on the data.
    """
    sent = frame.sparkSession.sparkContext.broadcast(tokenizer)
    at = frame.columns.index(text)
    kept = [k for k in range(len(frame.columns)) if keep or k != at]
    schema = T.StructType([frame.schema.fields[k] for k in kept] + fields)
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = sent.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part = batch.slice(lo, 100)
                rows = [make(tok, x) for x in part.column(at).to_pylist()]
                new = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in kept], *new], schema.names
                )

    return map_batches(frame, run, schema)


def encode_column(
    frame: DataFrame, tokenizer: Tokenizer, text: str = "text", out: str = "tokens"
) -> DataFrame:
    """Add the token ids of a text column as an array, and their number as ``n_tokens``."""
    fields = [
        T.StructField(free_name(frame, out), T.ArrayType(T.IntegerType())),
        T.StructField(free_name(frame, "n_tokens"), T.LongType()),
    ]

    def make(tok: Tokenizer, x: str | None) -> tuple:
        ids = tok.encode(x)
        return ids, len(ids)

    return _added(frame, tokenizer, text, fields, make)


def decode_column(
    frame: DataFrame, tokenizer: Tokenizer, tokens: str = "tokens", out: str = "decoded"
) -> DataFrame:
    """Add the text that an array of token ids stands for; NULL decodes to an empty text."""
    fields = [T.StructField(free_name(frame, out), T.StringType())]
    return _added(frame, tokenizer, tokens, fields, lambda tok, ids: (tok.decode(ids or ()),))


def coded_columns(
    frame: DataFrame, tokenizer: Tokenizer, text: str = "text", keep: bool = True
) -> DataFrame:
    """``encode_column`` and ``decode_column`` in one pass, so that a task needs one worker."""
    fields = [
        T.StructField(free_name(frame, "tokens"), T.ArrayType(T.IntegerType())),
        T.StructField(free_name(frame, "n_tokens"), T.LongType()),
        T.StructField(free_name(frame, "decoded"), T.StringType()),
    ]

    def make(tok: Tokenizer, x: str | None) -> tuple:
        ids = tok.encode(x)
        return ids, len(ids), tok.decode(ids)

    return _added(frame, tokenizer, text, fields, make, keep)


def round_trip_digests(
    frame: DataFrame, tokenizer: Tokenizer, text: str = "text", keep: bool = True
) -> DataFrame:
    """Encode, decode, and add the number of tokens and digests of ids and decoded text.

    The same as ``encode_column``, ``decode_column`` and hashing, without
    sending the ids of long texts through three operators.
    """
    fields = [
        T.StructField(free_name(frame, "n_tokens"), T.LongType()),
        T.StructField(free_name(frame, "ids_sha256"), T.StringType()),
        T.StructField(free_name(frame, "decoded_sha256"), T.StringType()),
    ]

    def make(tok: Tokenizer, x: str | None) -> tuple:
        ids = tok.encode(x)
        return (
            len(ids),
            hashlib.sha256(tok.decimal(ids).encode()).hexdigest(),
            hashlib.sha256(tok.decode(ids).encode("utf-8")).hexdigest(),
        )

    return _added(frame, tokenizer, text, fields, make, keep)
