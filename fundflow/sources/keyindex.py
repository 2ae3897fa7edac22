"""Which message holds each key, in bucketed segments.

A segment is a Parquet folder bucketed and sorted by key. New keys are shuffled
once to the buckets and joined with each segment where its rows lie, so looking
up a batch never shuffles what is known already. Segments are only added; the
message with the lowest place wins, so a key may stand in several and the lowest
is taken. When there are many, one merge replaces them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class KeyIndex:
    """Segments with columns ``schema``; ``place`` are those whose lowest values win."""

    def __init__(
        self, spark: SparkSession, schema: T.StructType, key: Sequence[str], place: Sequence[str], buckets: int
    ):
        self.spark, self.schema, self.buckets = spark, schema, buckets
        self.key, self.place = list(key), list(place)

    def write(self, rows: DataFrame, path: str) -> None:
        """A segment of rows with distinct keys: one file per bucket."""
        name = f"key_index_{uuid.uuid4().hex}"
        placed = rows.select(*self.schema.names).repartition(self.buckets, *self.key)
        try:
            (
                placed.write.bucketBy(self.buckets, *self.key)
                .sortBy(*self.key)
                .option("path", path)
                .saveAsTable(name, format="parquet")
            )
        finally:
            # The name is only needed to write buckets; the files stay.
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    @contextmanager
    def opened(self, paths: Sequence[str]) -> Iterator[list[DataFrame]]:
        """The segments as bucketed tables, known to the session within the block."""
        names = []
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        keys = ", ".join(f"`{k}`" for k in self.key)
        try:
            for path in paths:
                names.append(f"key_index_{uuid.uuid4().hex}")
                self.spark.sql(
                    f"CREATE TABLE {names[-1]} ({columns}) USING parquet"
                    f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS"
                    f" LOCATION '{path}'"
                )
            yield [self.spark.table(name) for name in names]
        finally:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def holders(self, segments: Sequence[DataFrame], keys: DataFrame) -> DataFrame:
        """For each of ``keys`` that is known, the row that holds it."""
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        found = [segment.join(keys, self.key) for segment in segments]
        return self._lowest(reduce(DataFrame.union, [f.select(*self.schema.names) for f in found]))

    def merged(self, segments: Sequence[DataFrame]) -> DataFrame:
        return self._lowest(reduce(DataFrame.union, segments))

    def _lowest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.schema.names if c not in self.key]
        order = [*self.place, *[c for c in rest if c not in self.place]]
        lowest = rows.groupBy(*self.key).agg(F.min(F.struct(*order)).alias("_lowest"))
        return lowest.select(
            *[F.col(c) if c in self.key else F.col(f"_lowest.{c}").alias(c) for c in self.schema.names]
        )
