"""Numbers of rows within groups and running sums, with no group in one task.

A window over a group reads it in one task. Here rows are range-partitioned by
group and order, so a large group lies over several partitions; each partition
adds up its own part, and what the partitions before it have of its first group
is added afterwards. That carry is one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.llm.common import map_batches, written

#: Sums are kept modulo this.
MODULUS = 1 << 62
_MASK = np.uint64(MODULUS - 1)


def _local(group: np.ndarray, values: list[np.ndarray], carried: tuple) -> tuple[list, tuple]:
    """Running sums of a batch whose groups are in order, and what to carry into the next one."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(starts, len(group)))
    key, totals = carried
    out = []
    for value, total in zip(values, totals):
        with np.errstate(over="ignore"):
            sums = np.cumsum(value.astype(np.uint64))
            before = sums[starts] - value[starts].astype(np.uint64)
            if key is not None and int(group[0]) == key:
                before[0] -= np.uint64(total)
            sums -= np.repeat(before, sizes)
        out.append(sums & _MASK)
    return out, (int(group[-1]), [int(x[-1]) for x in out])


def _carries(last: list[T.Row], n: int) -> list[tuple]:
    """For each partition whose first group began before it: the group's sums so far."""
    out, key, totals = [], None, [0] * n
    for row in sorted(last, key=lambda r: r["pid"]):
        sums = [row["last"][f"c{k}"] for k in range(n)]
        if key is not None and row["first"] == key:
            out.append((row["pid"], key, *totals))
        if row["last"]["g"] == key:
            sums = [(a + b) % MODULUS for a, b in zip(totals, sums)]
        key, totals = row["last"]["g"], sums
    return out


def plus(a: Column, b: Column) -> Column:
    return (a + b) % F.lit(MODULUS)


def running(
    frame: DataFrame,
    group: str,
    ranges: Sequence[str],
    order: Sequence[str],
    sums: Sequence[str],
    keep: Sequence[str],
    number: str = "n",
) -> DataFrame:
    """``group``, ``keep``, the number from 1 on, and the running sums of ``sums`` under their names.

    Rows of a group are in the order of ``order``; ``ranges`` are those of these
    columns that may tell partitions apart (rows equal in them stay together).
    ``group`` is a non-NULL long; ``sums`` are longs from 0 to below ``MODULUS``,
    added modulo it. The result is a written table.
    """
    rows = (
        frame.repartitionByRange(group, *ranges)
        .sortWithinPartitions(group, *order)
        .select(group, *keep, *[F.col(s).alias(f"v{k}") for k, s in enumerate(sums)])
    )
    at = len(keep) + 1
    names = [f"c{k}" for k in range(len(sums) + 1)]
    fields = [T.StructField(n, T.LongType()) for n in ("pid", *names)]
    schema = T.StructType([*rows.schema.fields[:at], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        pid = context.partitionId() if context else 0
        carried = (None, [0] * len(names))
        for batch in batches:
            if not batch.num_rows:
                continue
            values = [batch.column(at + k).to_numpy() for k in range(len(sums))]
            ones = np.ones(batch.num_rows, np.int64)
            found, carried = _local(batch.column(0).to_numpy(), [ones, *values], carried)
            new = [np.full(batch.num_rows, pid, np.int64), *[f.astype(np.int64) for f in found]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], *[pa.array(x) for x in new]], schema.names
            )

    local = written(map_batches(rows, run, schema, rows=None), "running")
    last = F.max(F.struct(F.col(group).alias("g"), *names)).alias("last")
    ends = local.groupBy("pid").agg(F.min(group).alias("first"), last).collect()
    carry_schema = f"pid long, `{group}` long, " + ", ".join(f"b{k} long" for k in range(len(names)))
    carry = frame.sparkSession.createDataFrame(_carries(ends, len(names)), carry_schema)
    joined = local.join(F.broadcast(carry), ["pid", group], "left")
    total = [plus(F.col(n), F.coalesce(F.col(f"b{k}"), F.lit(0))) for k, n in enumerate(names)]
    return joined.select(
        group, *keep, *[c.alias(n) for c, n in zip(total, (number, *sums))]
    )
