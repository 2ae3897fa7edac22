"""Distinct on a key, with a fixed choice of the surviving row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(
    rows: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    tally: str | None = None,
) -> DataFrame:
    """One row per key: the one with the lowest ``order``.

    The minimum of a struct merges, so every task sends at most one row per key
    to the shuffle however often the key occurs, and a key that holds a third of
    all rows costs its reducer one row per map task. Rows that tie on ``order``
    are told apart by their other columns; the result never depends on row
    order. With ``tally``, the number of rows of the key is returned in a column
    of that name.

    Spark sorts rows on their grouping columns for this, by the first one as far
    as it decides. Led by a hash of the key that is a sort of longs, whatever the
    key looks like; ids with a common beginning would be compared in full.
    """
    values = [c for c in rows.columns if c not in key and c not in order]
    lowest = F.min(F.struct(*order, *values)).alias("_lowest")
    counts: list[Column] = [F.count("*").alias(tally)] if tally else []
    hashed = F.xxhash64(*key).alias("_hash")
    columns = [
        F.col(c) if c in key else F.col(f"_lowest.{c}").alias(c) for c in rows.columns
    ]
    if tally:
        columns.append(F.col(tally))
    return rows.groupBy(hashed, *key).agg(lowest, *counts).select(*columns)
