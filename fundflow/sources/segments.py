"""Tables kept as segments: folders of rows by day, of which a version names the live ones.

A table is a mapping of each day to the segments that hold rows of it. Adding
rows adds a segment; replacing a day names one segment for it alone. Nothing is
changed in place, so readers of an earlier version are never disturbed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.sources.lake import DAY, by_day

#: The live segments of each day, by the name of the day's folder.
Live = Mapping[str, list[str]]
# Fixed value: the folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def day_name(day: str | Column = DAY) -> Column:
    """The folder of a day."""
    day = F.col(day) if isinstance(day, str) else day
    return F.coalesce(day.cast("string"), F.lit(NO_DAY))


def new_segment() -> str:
    return uuid.uuid4().hex


def write_segment(rows: DataFrame, root: str, segment: str) -> None:
    """Rows placed by day: one task per small day, several for a large one."""
    by_day(rows).write.partitionBy(DAY).parquet(f"{root}/segment={segment}")


def read_segments(
    spark: SparkSession, root: str, schema: T.StructType, live: Live, days: Iterable[str] | None = None
) -> DataFrame:
    """The live rows of all days, or of some, in one scan."""
    wanted = live if days is None else [d for d in days if d in live]
    paths = [f"{root}/segment={s}/{DAY}={d}" for d in wanted for s in live[d]]
    if not paths:
        return spark.createDataFrame([], schema)
    files = T.StructType([*schema.fields, T.StructField("segment", T.StringType())])
    table = spark.read.schema(files).option("basePath", root).parquet(*paths)
    return table.select(*schema.names)


def with_added(live: Live, segment: str, days: Iterable[str]) -> dict[str, list[str]]:
    """The mapping with a segment added to some days."""
    out = {day: list(segments) for day, segments in live.items()}
    for day in days:
        out.setdefault(day, []).append(segment)
    return out


def without(live: Live, days: Iterable[str]) -> dict[str, list[str]]:
    gone = set(days)
    return {day: list(segments) for day, segments in live.items() if day not in gone}


def changed_days(before: Live, after: Live) -> tuple[dict[str, list[str]], dict[str, list[str]], list[str]]:
    """What happened between two versions: days with segments added, days replaced, days gone.

    Of the first the new segments are given, of the second all.
    """
    added, replaced = {}, {}
    for day, segments in after.items():
        old = before.get(day, [])
        if segments == old:
            continue
        if segments[: len(old)] == old:
            added[day] = segments[len(old) :]
        else:
            replaced[day] = list(segments)
    return added, replaced, [day for day in before if day not in after]
