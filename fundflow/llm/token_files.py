"""Token ids in files: ranks by frequency, in a byte-aligned code with control bytes apart.

Ids are counted over the whole corpus and replaced by their rank, the most
frequent first, so that the 256 most frequent ones take one byte. A rank takes
one to four bytes, least byte first. Its length less one is two bits of a control
byte, four ranks to a byte, first rank lowest; control bytes and data bytes lie
apart, so a reader knows all lengths before it touches the data. Decoding looks
up, for each control byte, where the sixteen bytes of its four ranks come from.

A folder of token files holds

* ``ranks``: the id of each rank, four bytes each, least byte first,
* ``shard-N.tokens``: blocks of whole documents in ascending order of their id, and
* ``manifest.json``: the shards in order, with their documents, ids and first place.

A block is a head (documents, ids, control bytes, data bytes, checksum), then
document ids, flags of ids that are NULL, numbers of ids, control bytes, data bytes.
All numbers are little-endian. Tasks write shards under hidden names; the commit on
the driver names those of the tasks that succeeded, in order, and writes the
manifest last, so a lost or repeated task leaves nothing that a reader sees.

Defined results: a NULL or empty text has only the end id, if there is one; a NULL
document id comes first; documents with the same id are in order of their ids'
checksum; repeated rows are all written; an empty table gives a folder without
shards; other columns are not written. A shard that is cut short or whose
checksum differs fails the job, as does a folder that has a manifest already.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from fundflow.llm.common import byte_slices, map_batches, plain, ship, written
from fundflow.llm.word_table import binary_rows, table_of

#: Bytes of text encoded at a time, ids in a block, bytes in a shard.
BATCH_BYTES = 8 << 20
BLOCK_IDS = 1 << 20
SHARD_BYTES = 256 << 20
_MAGIC = b"FFTOKEN1"
_HEAD = struct.Struct("<QQQQI")


# The code


def _length_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each control byte: its data bytes; where its sixteen bytes come from; which are real."""
    control = np.arange(256)
    lengths = 1 + ((control[:, None] >> np.array([0, 2, 4, 6])) & 3)
    starts = np.cumsum(lengths, axis=1) - lengths
    byte = np.arange(4)
    real = byte < lengths[:, :, None]
    source = np.where(real, starts[:, :, None] + byte, 0)
    return lengths.sum(axis=1), source.reshape(256, 16), real.reshape(256, 16)


_TOTAL, _SOURCE, _REAL = _length_tables()
_KEEP = np.where(_REAL, 0xFF, 0).astype(np.uint8)
_BYTES = np.arange(4) < np.arange(1, 5)[:, None]


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of some ranks."""
    ranks = ranks.astype("<u4")
    codes = (ranks >= 1 << 8).astype(np.uint8)
    codes += ranks >= 1 << 16
    codes += ranks >= 1 << 24
    data = ranks.view(np.uint8).reshape(-1, 4)[_BYTES[codes]]
    padded = np.zeros(-len(ranks) % 4 + len(ranks), np.uint8)
    padded[: len(ranks)] = codes
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of ``pack``, by table look-up for each control byte."""
    quads = np.frombuffer(control, np.uint8)
    if len(quads) != -(-n // 4):
        raise ValueError(f"{len(quads)} control bytes for {n} ids")
    ends = np.cumsum(_TOTAL[quads])
    # Places past the end of a short last group of four are not in the data.
    absent = -n % 4
    if n and int(ends[-1]) - absent != len(data):
        raise ValueError(f"{len(data)} data bytes, {int(ends[-1]) - absent} by the control bytes")
    held = np.frombuffer(data + bytes(4), np.uint8)
    out = np.empty(4 * len(quads), "<u4")
    for lo in range(0, len(quads), 1 << 16):
        part = quads[lo : lo + (1 << 16)]
        starts = ends[lo : lo + len(part)] - _TOTAL[part]
        found = held[starts[:, None] + _SOURCE[part]] & _KEEP[part]
        out[4 * lo : 4 * (lo + len(part))] = found.view("<u4").reshape(-1)
    return out[:n]


def block(ids: Sequence[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    """Some documents with their ranks, which lie one after the other, as bytes of a shard."""
    control, data = pack(ranks)
    nulls = np.array([i is None for i in ids], np.uint8)
    body = b"".join(
        [
            np.array([i or 0 for i in ids], "<i8").tobytes(),
            nulls.tobytes(),
            counts.astype("<u8").tobytes(),
            control,
            data,
        ]
    )
    return _HEAD.pack(len(nulls), len(ranks), len(control), len(data), zlib.crc32(body)) + body


@dataclass(frozen=True)
class Block:
    ids: list[int | None]
    counts: np.ndarray
    ranks: np.ndarray | None


def blocks(stream, decode: bool) -> Iterator[Block]:
    """The blocks of a shard; without ``decode`` the codes are skipped."""
    size = stream.size()
    if stream.read(len(_MAGIC)) != _MAGIC:
        raise ValueError("not a shard of token ids")
    while head := stream.read(_HEAD.size):
        if len(head) < _HEAD.size:
            raise EOFError("the shard ends within the head of a block")
        docs, n, controls, bytes_, checksum = _HEAD.unpack(head)
        if stream.tell() + 17 * docs + controls + bytes_ > size:
            raise EOFError("the shard ends within a block")
        table = stream.read(17 * docs)
        ids = np.frombuffer(table, "<i8", docs).tolist()
        nulls = np.frombuffer(table, np.uint8, docs, 8 * docs)
        counts = np.frombuffer(table, "<u8", docs, 9 * docs).astype(np.int64)
        for k in np.flatnonzero(nulls).tolist():
            ids[k] = None
        ranks = None
        if decode:
            codes = stream.read(controls + bytes_)
            if zlib.crc32(codes, zlib.crc32(table)) != checksum:
                raise ValueError("a block differs from its checksum")
            ranks = unpack(codes[:controls], codes[controls:], n)
        else:
            stream.seek(stream.tell() + controls + bytes_)
        yield Block(ids, counts, ranks)


# Files


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


def _put(path: str, name: str, content: bytes) -> None:
    """Write a file under a hidden name and give it its own."""
    store, root = _store(path)
    store.create_dir(root, recursive=True)
    hidden = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(hidden, compression=None) as out:
        out.write(content)
    store.move(hidden, f"{root}/{name}")


def _get(path: str, name: str) -> bytes:
    store, root = _store(path)
    with store.open_input_stream(f"{root}/{name}", compression=None) as file:
        return file.read()


@dataclass
class Shards(WriterCommitMessage):
    """What one task wrote: hidden name, documents and ids of each file, in order."""

    partition: int
    files: tuple[tuple[str, int, int], ...]


class TokenWriter(DataSourceArrowWriter):
    """Writes rows ``(doc_id, ids)``, which come in order, as shards."""

    def __init__(self, path: str, width: int, block_ids: int, shard_bytes: int):
        self.path, self.width = path, width
        self.block_ids, self.shard_bytes = block_ids, shard_bytes

    def _blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        by_rank = np.frombuffer(_get(self.path, "ranks"), "<u4")
        rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
        rank_of[by_rank] = np.arange(len(by_rank), dtype="<u4")
        for part in byte_slices(batches, 1, self.block_ids * self.width):
            held = part.column(1).to_pylist()
            ids = np.frombuffer(b"".join(held), f"<u{self.width}")
            counts = np.array([len(x) // self.width for x in held], np.int64)
            made = block(part.column(0).to_pylist(), counts, rank_of[ids])
            yield len(counts), len(ids), made

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        store, root = _store(self.path)
        context = TaskContext.get()
        partition = context.partitionId() if context else 0
        files: list[list] = []
        out, size = None, 0
        try:
            for docs, ids, made in self._blocks(iterator):
                if out is None:
                    files.append([f".{partition:06d}-{uuid.uuid4().hex}", 0, 0])
                    out = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None)
                    out.write(_MAGIC)
                    size = 0
                out.write(made)
                size += len(made)
                files[-1][1] += docs
                files[-1][2] += ids
                if size >= self.shard_bytes:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Shards(partition, tuple(tuple(f) for f in files))

    def commit(self, messages: list[Shards | None]) -> None:
        store, root = _store(self.path)
        entries, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for hidden, docs, ids in message.files:
                name = f"shard-{len(entries):06d}.tokens"
                store.move(f"{root}/{hidden}", f"{root}/{name}")
                entries.append({"name": name, "docs": docs, "ids": ids, "start": start})
                start += ids
        _put(self.path, "manifest.json", json.dumps({"ids": start, "shards": entries}).encode())

    def abort(self, messages: list[Shards | None]) -> None:
        store, root = _store(self.path)
        for hidden in (f[0] for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{hidden}")


# Columns of a read; ``ids`` are the ids as four bytes each, least byte first.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
        T.StructField("ids", T.BinaryType()),
    ]
)


@dataclass
class Part(InputPartition):
    shards: tuple[tuple[str, int], ...]


class TokenReader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, partition_bytes: int):
        self.names, self.path, self.partition_bytes = schema.names, path, partition_bytes

    def partitions(self) -> list[Part]:
        """Neighbouring shards together, up to so many ids."""
        out: list[list] = []
        room = 0
        for s in json.loads(_get(self.path, "manifest.json"))["shards"]:
            if not out or 4 * s["ids"] > room:
                out.append([])
                room = self.partition_bytes
            out[-1].append((s["name"], s["start"]))
            room -= 4 * s["ids"]
        return [Part(tuple(p)) for p in out] or [Part(())]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        store, root = _store(self.path)
        decode = bool({"tokens", "ids"} & set(self.names))
        by_rank = np.frombuffer(_get(self.path, "ranks"), "<u4")
        for name, start in partition.shards:
            with store.open_input_file(f"{root}/{name}") as stream:
                for one in blocks(stream, decode):
                    ends = np.cumsum(one.counts)
                    columns = {
                        "doc_id": lambda: pa.array(one.ids, pa.int64()),
                        "start": lambda: pa.array(start + ends - one.counts, pa.int64()),
                        "n_tokens": lambda: pa.array(one.counts, pa.int64()),
                        "tokens": lambda: pa.ListArray.from_arrays(
                            np.concatenate(([0], ends)).astype(np.int32),
                            pa.array(by_rank[one.ranks].astype(np.int32)),
                        ),
                        "ids": lambda: binary_rows(by_rank[one.ranks], one.counts),
                    }
                    yield pa.RecordBatch.from_arrays(
                        [columns[n]() for n in self.names], self.names
                    )
                    start += int(one.counts.sum())


class TokenSource(DataSource):
    """The format ``token_files``; see ``write_tokens`` and ``read_tokens``."""

    @classmethod
    def name(cls) -> str:
        return "token_files"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> TokenReader:
        return TokenReader(schema, self.options["path"], int(self.options["partitionBytes"]))

    def writer(self, schema: T.StructType, overwrite: bool) -> TokenWriter:
        o = self.options
        return TokenWriter(o["path"], int(o["width"]), int(o["blockIds"]), int(o["shardBytes"]))


# Frames


def encoded(
    docs: DataFrame, tokenizer_file: str, end: int | None = None, ident: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, int]:
    """``(doc_id, ids)`` of every text, ids as bytes of the returned width.

    The tokenizer file goes out as a broadcast of its own size (some MB).
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())
    width = table_of(sent.value).dtype.itemsize
    key, body = plain(docs, [ident, text])
    rows = docs.select(key.cast("long").alias("doc_id"), body.cast("string").alias("text"))
    schema = "doc_id long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(sent.value)
        for part in byte_slices(batches, 1, BATCH_BYTES):
            ids, counts = table.encode(part.column(1), end)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), binary_rows(ids, counts)], ["doc_id", "ids"]
            )

    return map_batches(rows, run, schema, rows=None), width


def id_counts(rows: DataFrame, width: int) -> DataFrame:
    """``(token, n)``: how often each id occurs. A task sends one row per id it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for part in byte_slices(batches, 0, BATCH_BYTES):
            ids = np.frombuffer(b"".join(part.column(0).to_pylist()), f"<u{width}")
            found = np.bincount(ids, minlength=len(counts))
            found[: len(counts)] += counts
            counts = found
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(counts[seen])], ["token", "n"]
        )

    counted = map_batches(rows.select("ids"), run, "token long, n long", rows=None)
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end: int | None = None,
    ident: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode every text and write the ids, by ascending document id, to a new folder.

    Texts are encoded once; their ids are written to the shared folder, counted,
    brought into order by a range shuffle, and written as shards. The driver
    holds one number per id of the tokenizer and one line per shard.
    """
    spark = docs.sparkSession
    ship(spark)
    spark.dataSource.register(TokenSource)
    store, root = _store(path)
    if store.get_file_info(f"{root}/manifest.json").type != fs.FileType.NotFound:
        raise ValueError(f"{path} holds token files already")
    rows, width = encoded(docs, tokenizer_file, end, ident, text)
    rows = written(rows, "ids", compression="zstd")
    by_rank = id_counts(rows, width).orderBy(F.desc("n"), "token").toPandas()["token"]
    _put(path, "ranks", by_rank.to_numpy("<u4").tobytes())
    ordered = rows.orderBy("doc_id", F.crc32("ids")).select("doc_id", "ids")
    ordered.write.format("token_files").mode("append").options(
        path=path, width=width, blockIds=block_ids, shardBytes=shard_bytes
    ).save()


def read_tokens(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    partition_bytes: int = 64 << 20,
) -> DataFrame:
    """Documents of a folder of token files, by columns of ``SCHEMA``.

    Without ``tokens`` and ``ids`` no code is read. ``start`` is the number of
    ids of all documents before.
    """
    ship(spark)
    spark.dataSource.register(TokenSource)
    wanted = T.StructType([f for f in SCHEMA if columns is None or f.name in columns])
    return (
        spark.read.format("token_files")
        .schema(wanted)
        .options(path=path, partitionBytes=partition_bytes)
        .load()
    )
