"""Chat formatting by a finite-state machine over roles.

A template declares the marks around a turn, which role may follow which, where
a conversation may end, and whose text is trained on. The machine reads the
turns of a conversation in order and emits segments with a loss flag for each.
Control strings inside texts are escaped: between ``<`` and ``|`` one more
backslash is put, which ``unescape`` takes away again, so every text comes back
as it was and no text can open or close a turn.

Conversations are brought together by a shuffle on their id and sorted by turn;
the machine then runs over the rows as a stream. It holds one turn at a time:
a conversation with very many turns takes time in its task, not memory.

Defined results: a NULL text or role is an empty one; a NULL conversation id is
an id of its own; turns with the same number are ordered by role, then text,
NULL first; repeated rows are repeated turns. A conversation that breaks the
order is formatted all the same and marked. An empty table gives no segments.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fundflow.llm.common import map_batches, plain

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
START = ""


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line of the output."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Template:
    """Marks of a turn and the machine over roles. Marks must hold ``<|``, which texts cannot."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            START: frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})
    trained: frozenset[str] = frozenset({"assistant"})

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """Segments of one turn with their loss flags."""
        head = f"{self.opening}{escape_role(role)}\n"
        return [(head, False), (escape(text), role in self.trained), (self.closing, False)]


SEGMENTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("segment", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("loss", T.BooleanType()),
        # On the last segment of a conversation: whether the machine accepts it.
        T.StructField("valid", T.BooleanType()),
    ]
)
_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("segment", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.bool_()),
        ("valid", pa.bool_()),
    ]
)
_TOGETHER = 1_000


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def segments(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """The segments of all conversations, in order within each."""
    template = template or Template()
    names = ["conv_id", "turn", "role", "text"]
    turns = conversations.select(*[c.alias(n) for c, n in zip(plain(conversations, names), names)])
    ordered = turns.repartition("conv_id").sortWithinPartitions(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, state, good, n = False, None, START, True, 0
        out: list[tuple] = []
        for batch in batches:
            for lo in range(0, batch.num_rows, _TOGETHER):
                part = batch.slice(lo, _TOGETHER)
                ids, roles, texts = (part.column(k).to_pylist() for k in (0, 2, 3))
                for ident, role, text in zip(ids, roles, texts):
                    role = role or ""
                    if not begun or ident != conv:
                        if begun:
                            out[-1] = (*out[-1][:4], good and state in template.final)
                        begun, conv, state, good, n = True, ident, START, True, 0
                    good = good and role in template.follows.get(state, ())
                    state = role
                    for piece, loss in template.turn(role, text or ""):
                        out.append((conv, n, piece, loss, None))
                        n += 1
                # The last one waits: only the next row tells whether it ends a conversation.
                yield _table(out[:-1], _ARROW)
                out = out[-1:]
        if begun:
            out[-1] = (*out[-1][:4], good and state in template.final)
        yield _table(out, _ARROW)

    return map_batches(ordered, run, SEGMENTS)


READ_BACK = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
        T.StructField("valid", T.BooleanType()),
    ]
)
_BACK_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
    ]
)


class Reader:
    """Reads the turns of one conversation back from its formatted text, piece by piece."""

    def __init__(self, template: Template):
        self.template = template
        self.parts: list[str] = []
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str, loss: bool) -> None:
        self.chars += len(piece)
        if loss:
            trained = unescape(piece)
            self.loss_chars += len(trained)
            self.loss.update(trained.encode("utf-8"))
        self.parts.append(piece)
        # A closing mark may be spread over pieces; texts cannot hold one.
        tail = "".join(self.parts[-3:])[-2 * len(self.template.closing) :]
        if self.template.closing in tail:
            rest = "".join(self.parts)
            while (end := rest.find(self.template.closing)) >= 0:
                self._turn(rest[:end])
                rest = rest[end + len(self.template.closing) :]
            self.parts = [rest] if rest else []

    def _turn(self, formatted: str) -> None:
        if not formatted.startswith(self.template.opening):
            raise ValueError("a turn without its opening mark")
        role, text = formatted[len(self.template.opening) :].split("\n", 1)
        self.n_turns += 1
        self.turns.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())

    def row(self, conv: int | None, valid: bool) -> tuple:
        if self.parts:
            raise ValueError("a turn without its closing mark")
        return (
            conv,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.chars,
            valid,
        )


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Digests of what the segments say, parsed from their text and loss flags alone.

    ``formatted`` must be the frame ``segments`` gives, whose partitions hold
    whole conversations in order.
    """
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(template)
        for batch in batches:
            out = []
            for conv, _, text, loss, valid in zip(*(c.to_pylist() for c in batch.columns)):
                reader.feed(text, loss)
                if valid is not None:
                    out.append(reader.row(conv, valid))
                    reader = Reader(template)
            yield _table(out, _BACK_ARROW)

    return map_batches(formatted, run, READ_BACK)
