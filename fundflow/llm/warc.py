"""WARC archives as a Spark data source.

Reading: the driver lists the archives below a path and packs whole files into
partitions, largest first. A task reads its files record by record as a stream:
header lines first; if the record type or another header fails a pushed filter,
or no column needs the block, the block is skipped (uncompressed files: by a
seek) and never decoded. Writing: each task writes one gzip member per record
into files of its own under a hidden name; the commit on the driver gives them
their names, so a lost or repeated task leaves nothing that readers see.

Filters on ``record_type``, ``record_id``, ``target_uri``, ``date``,
``payload_digest``, ``refers_to`` and ``content_type`` are pushed down where the
session allows it for Python sources; ``read_warc`` turns that setting on. The
option ``verify`` compares payloads with their digests and fails on a difference.

Defined results: a record without a header has NULL there; a NULL payload is
written as an empty one; a payload may be any bytes, of any length that fits
the memory of a task; line ends in header values are percent-encoded; repeated
rows are repeated records; an empty frame writes no files, an empty or missing
folder has no records; unknown columns are not written. A file that ends within
a record fails the job.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from fundflow.llm.common import plain, ship

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

# Column and the header it comes from.
_HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "content_type": "content-type",
}
SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in _HEADERS],
        T.StructField("content_length", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_BLOCK_COLUMNS = {"payload", "payload_bytes"}
_PIECE = 1 << 16
_VERSION = b"WARC/1.1"
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """A store by its address; a bare path is a local one."""
    return fs.FileSystem.from_uri(path if "://" in path else path.removeprefix("file:"))


# Reading


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


@dataclass(frozen=True)
class HeaderTest:
    """A pushed filter on one header column."""

    column: str
    kind: str
    values: tuple

    def holds(self, row: dict) -> bool:
        value = row.get(self.column)
        if self.kind == "null":
            return value is None
        if self.kind == "same" and self.values[0] is None:
            return value is None
        if value is None:
            return False
        if self.kind == "starts":
            return value.startswith(self.values[0])
        if self.kind == "ends":
            return value.endswith(self.values[0])
        if self.kind == "contains":
            return self.values[0] in value
        return True if self.kind == "some" else value in self.values

    @classmethod
    def of(cls, pushed: Filter) -> HeaderTest | None:
        """The test for a filter that can be decided by headers alone, or None."""
        column = pushed.attribute[0] if len(getattr(pushed, "attribute", ())) == 1 else None
        if column not in _HEADERS:
            return None
        kinds = {
            EqualTo: "in",
            EqualNullSafe: "same",
            StringStartsWith: "starts",
            StringEndsWith: "ends",
            StringContains: "contains",
        }
        if type(pushed) in kinds:
            return cls(column, kinds[type(pushed)], (pushed.value,))
        if isinstance(pushed, In):
            return cls(column, "in", tuple(pushed.value))
        if isinstance(pushed, (IsNull, IsNotNull)):
            return cls(column, "null" if isinstance(pushed, IsNull) else "some", ())
        return None


def _clean(name: str, value: str | None) -> str | None:
    if value is None:
        return None
    if name in ("record_id", "refers_to"):
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix("sha1:") if name == "payload_digest" else value


def headers(stream: io.BufferedIOBase) -> dict[str, str] | None:
    """Header lines of the next record, names in lower case; None at the end of the file."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no record where one should begin: {line[:40]!r}")
    found: dict[str, str] = {}
    name = ""
    while (line := stream.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise EOFError("the file ends within a header")
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[0] in " \t" and name:
            found[name] += " " + text.strip()
            continue
        name, _, value = text.partition(":")
        name = name.strip().lower()
        found[name] = value.strip()
    return found


def records(
    stream: io.BufferedIOBase, tests: Sequence[HeaderTest], block: bool, verify: bool
) -> Iterator[dict]:
    """Records that pass all tests; the blocks of others are skipped."""
    seekable = not isinstance(stream, gzip.GzipFile)
    while (found := headers(stream)) is not None:
        length = int(found["content-length"])
        row = {c: _clean(c, found.get(h)) for c, h in _HEADERS.items()}
        row["content_length"] = length
        if (block or verify) and all(t.holds(row) for t in tests):
            body = stream.read(length)
            if len(body) < length:
                raise EOFError("the file ends within a record")
            payload = body
            if (row["content_type"] or "").startswith("application/http"):
                payload = body.partition(b"\r\n\r\n")[2]
            row["payload"], row["payload_bytes"] = payload, len(payload)
            if verify and row["record_type"] != "revisit" and row["payload_digest"]:
                if base32_sha1(payload) != row["payload_digest"]:
                    raise ValueError(f"payload of {row['record_id']} differs from its digest")
            yield row
            continue
        if seekable:
            stream.seek(length, io.SEEK_CUR)
        else:
            while length and (piece := stream.read(min(length, _PIECE))):
                length -= len(piece)
        if all(t.holds(row) for t in tests):
            yield row


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, verify: bool, partition_bytes: int):
        self.names = schema.names
        self.path, self.verify, self.partition_bytes = path, verify, partition_bytes
        self.tests: list[HeaderTest] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for pushed in filters:
            test = HeaderTest.of(pushed)
            if test is None:
                yield pushed
            else:
                self.tests.append(test)

    def partitions(self) -> list[Files]:
        """Whole files, largest first, each into the first partition that still has room."""
        store, root = _filesystem(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True, recursive=True))
        sizes = [
            (f.size, f.path)
            for f in found
            if f.is_file
            and f.base_name.endswith((".warc", ".warc.gz"))
            and not f.base_name.startswith((".", "_"))
        ]
        out: list[list[str]] = []
        room = 0
        for size, path in sorted(sizes, reverse=True):
            if not out or size > room:
                out.append([])
                room = self.partition_bytes
            out[-1].append(path)
            room -= size
        return [Files(tuple(paths)) for paths in out] or [Files(())]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = _filesystem(self.path)
        block = bool(_BLOCK_COLUMNS & set(self.names))
        for path in partition.paths:
            with store.open_input_file(path) as file:
                plain_stream = io.BufferedReader(file, _PIECE)
                stream = (
                    gzip.GzipFile(fileobj=plain_stream) if path.endswith(".gz") else plain_stream
                )
                for row in records(stream, self.tests, block, self.verify):
                    yield tuple(row.get(n) for n in self.names)


# Writing


@dataclass
class Written(WriterCommitMessage):
    files: tuple[str, ...]


def _line(name: str, value: str) -> bytes:
    value = value.replace("\r", "%0D").replace("\n", "%0A")
    return f"{name}: {value}\r\n".encode()


def record(row: dict) -> bytes:
    """One record. A response has an HTTP block around its payload, a revisit has none."""
    payload = row.get("payload") or b""
    kind = row.get("record_type") or "response"
    body = b""
    if kind == "response":
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        body = head + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    elif kind != "revisit":
        body = payload
    lines = [_VERSION + b"\r\n", _line("WARC-Type", kind)]
    lines.append(_line("WARC-Record-ID", f"<{row.get('record_id') or f'urn:uuid:{uuid.uuid4()}'}>"))
    lines.append(_line("WARC-Date", row.get("date") or "1970-01-01T00:00:00Z"))
    if row.get("target_uri") is not None:
        lines.append(_line("WARC-Target-URI", row["target_uri"]))
    digest = row.get("payload_digest") or base32_sha1(payload)
    lines.append(_line("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        lines.append(_line("WARC-Profile", _SAME_PAYLOAD))
        if row.get("refers_to") is not None:
            lines.append(_line("WARC-Refers-To", f"<{row['refers_to']}>"))
    http = kind in ("response", "revisit")
    lines.append(
        _line("Content-Type", "application/http; msgtype=response" if http
              else row.get("content_type") or "application/octet-stream")
    )
    lines.append(_line("Content-Length", str(len(body))))
    return b"".join([*lines, b"\r\n", body, b"\r\n\r\n"])


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, file_bytes: int, level: int):
        if overwrite:
            raise ValueError("archives are appended to; write to a new folder instead")
        self.path, self.file_bytes, self.level = path, file_bytes, level

    def write(self, iterator: Iterator) -> Written:
        store, root = _filesystem(self.path)
        context = TaskContext.get()
        label = f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}"
        files: list[str] = []
        out, size = None, 0
        try:
            for row in iterator:
                if out is None:
                    store.create_dir(root, recursive=True)
                    files.append(f"{root}/.{label}-{len(files):04d}.warc.gz")
                    out, size = store.open_output_stream(files[-1], compression=None), 0
                packed = gzip.compress(record(row.asDict()), self.level, mtime=0)
                out.write(packed)
                size += len(packed)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Written(tuple(files))

    def commit(self, messages: list[Written | None]) -> None:
        store, _ = _filesystem(self.path)
        for file in (f for m in messages if m for f in m.files):
            folder, _, name = file.rpartition("/")
            store.move(file, f"{folder}/{name.removeprefix('.')}")

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = _filesystem(self.path)
        for file in (f for m in messages if m for f in m.files):
            store.delete_file(file)


class WarcSource(DataSource):
    """``spark.read.format("warc").load(path)``, ``frame.write.format("warc").save(path)``.

    Options: ``verify`` (false), ``partitionBytes`` (128 MB) when reading;
    ``fileBytes`` (1 GB), ``level`` of compression (3) when writing.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        verify = self.options.get("verify", "false").lower() == "true"
        size = int(self.options.get("partitionBytes", 128 << 20))
        return WarcReader(schema, self.options["path"], verify, size)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(
            self.options["path"],
            overwrite,
            int(self.options.get("fileBytes", 1 << 30)),
            int(self.options.get("level", 3)),
        )


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let it push filters into Python sources."""
    ship(spark)
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WarcSource)


def read_warc(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, verify: bool = False
) -> DataFrame:
    """Records below a path. Without ``payload`` and ``payload_bytes`` no block is decoded."""
    register(spark)
    wanted = T.StructType([f for f in SCHEMA if columns is None or f.name in columns])
    return (
        spark.read.format("warc").schema(wanted).option("verify", str(verify).lower()).load(path)
    )


def write_warc(rows: DataFrame, path: str, file_bytes: int = 1 << 30) -> None:
    """Append records below a path: columns by the names of ``SCHEMA``, others are left out."""
    register(rows.sparkSession)
    known = [c for c in rows.columns if c in SCHEMA.names]
    rows.select(*known).write.format("warc").mode("append").option("fileBytes", file_bytes).save(
        path
    )


def page_records(
    pages: DataFrame,
    ident: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> DataFrame:
    """Records of pages; of equal payloads the page with the largest id is the response.

    The others are revisits of it, without a block. Payloads shorter than
    ``least_bytes`` are all responses. Digests are grouped without the payloads,
    merged map-side; payloads move once, to meet their group, in a join whose
    large partitions adaptive execution can split. A NULL id comes last; pages with
    the same id and payload are all responses.
    """
    key, url, body = plain(pages, [ident, uri, payload])
    rows = pages.select(
        key.cast("long").alias("id"),
        url.cast("string").alias("target_uri"),
        F.coalesce(body.cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    groups = (
        rows.filter(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("id").alias("holder"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    revisit = F.col("holder").isNotNull() & ~F.col("id").eqNullSafe(F.col("holder"))
    revisit = revisit & (F.length("payload") >= least_bytes)
    name = "urn:page:"
    return (
        rows.join(groups, "digest", "left")
        .withColumn("again", revisit)
        .select(
            F.concat(F.lit(name), F.coalesce(F.col("id").cast("string"), F.lit(""))).alias("record_id"),
            F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
            "target_uri",
            F.when(F.col("again"), F.concat(F.lit(name), F.col("holder"))).alias("refers_to"),
            "payload",
        )
    )


def page_id(column: str) -> Column:
    """The page a record name stands for; NULL for a page without an id."""
    digits = F.regexp_extract(F.col(column), r"^urn:page:(-?\d+)$", 1)
    return F.when(digits != "", digits.cast("long"))
