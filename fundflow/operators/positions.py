"""The place of every row of a frame in one order."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.sources.workspace import new_folder

# Fixed value: monotonically_increasing_id has the row in so many low bits, the partition above.
_ROW_BITS = 33


def positions(frame: DataFrame, order: Sequence[Column], out: str = "position") -> DataFrame:
    """Every row with its number from 1 in ``order``, which should leave no two rows level.

    ``row_number`` over one order moves all rows into one task. Here rows are
    range-partitioned and sorted where they are; a row's number is that within its
    partition plus the rows of all partitions before, and only one count per
    partition passes the driver. The sorted rows are written once, so that
    numbers stay what they are when an executor is lost.
    """
    spark = frame.sparkSession
    path = new_folder(spark, "positions")
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_at", _ROW_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    parts = counts.agg(F.sort_array(F.collect_list(F.struct("_part", "n")))).first()[0]
    before = accumulate((p["n"] for p in parts), initial=0)
    offsets = [(p["_part"], n) for p, n in zip(parts, before)]
    table = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _before bigint"))
    row = F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)
    numbered = placed.withColumn("_part", part).join(table, "_part")
    return numbered.select(*frame.columns, (F.col("_before") + row + 1).alias(out))
