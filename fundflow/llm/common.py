"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import fundflow
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.sources.workspace import new_folder


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once for each application.

    Spark serves the file to them and puts it on the path of their Python
    workers, so the library need not be installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(fundflow.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='fundflow-')}/fundflow.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


#: Rows that Python turns into objects at a time.
BATCH_ROWS = 400


def map_batches(
    frame: DataFrame, run: Callable, schema: T.StructType | str, rows: int | None = BATCH_ROWS
) -> DataFrame:
    """``mapInArrow`` with this library at hand on the executors.

    Batches come in slices of ``rows``, so that a worker holds few texts as
    Python objects whatever the session's batch size; with None as Spark cuts them.
    """
    ship(frame.sparkSession)

    def sliced(batches):
        for batch in batches:
            size = rows or max(1, batch.num_rows)
            for lo in range(0, batch.num_rows, size):
                yield batch.slice(lo, size)

    return frame.mapInArrow(lambda batches: run(sliced(batches)), schema)


def byte_slices(
    batches: Iterable[pa.RecordBatch], column: int, size: int
) -> Iterator[pa.RecordBatch]:
    """The batches in slices with at most ``size`` bytes of one text column, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            done = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in one array, and the number of words of each text."""
    plain = pc.ascii_trim_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    words = pc.ascii_split_whitespace(plain)
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = words.flatten()
    # An empty text is one empty word to the splitter.
    empty = pc.equal(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)
    if empty.any():
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
        counts[empty] = 0
    return flat, counts


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame does not have, whatever the case of its names."""
    taken = {c.lower() for c in frame.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def written(frame: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The frame written to the shared folder and read again.

    Cuts the lineage: later jobs read files that outlive any executor, and
    values that a second run would change (row numbers) are fixed.
    """
    path = new_folder(frame.sparkSession, label)
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_row_id(frame: DataFrame, name: str) -> DataFrame:
    """Give every row a number of its own; fix it by ``written`` before using it twice."""
    return frame.withColumn(name, F.monotonically_increasing_id())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_fold(column: str, folds: int) -> Column:
    """crc32 of the decimal id modulo ``folds``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, marks, digits and underscores of a text, in order."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0)
    )


def plain(frame: DataFrame, names: Iterable[str]) -> list[Column]:
    """Columns by name, also names with dots or backticks."""
    return [frame["`" + n.replace("`", "``") + "`"] for n in names]
