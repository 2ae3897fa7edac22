"""Bronze days in few files, while the stream goes on writing many.

A stream leaves some files for each day and batch, and the log of its sink names all
of them. A compaction reads the files of a day that the log names now, writes
their rows as one segment of few large files, and commits the segment with the
list of files it stands for. Readers take the segments and whatever the log names
besides. The driver holds the names of the files, as in any read of such a folder; the stream is never stopped, and its files and log are not touched, so
its own readers (and a restart) see what they always saw. A batch that lands
during a compaction is not on its list and is read from its own files.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.schemas import BRONZE_SCHEMA
from fundflow.sources.lake import DAY
from fundflow.sources.segments import (
    NO_DAY,
    new_segment,
    read_segments,
    with_added,
    without,
    write_segment,
)
from fundflow.sources.snapshots import Snapshots, Version

_COVERED = "path string, day string"


class CompactedBronze:
    """A bronze folder that a stream writes, and below ``root`` its days in few files."""

    def __init__(self, spark: SparkSession, bronze: str, root: str):
        self.spark, self.bronze, self.root = spark, bronze.rstrip("/"), root.rstrip("/")
        self.versions = Snapshots(spark, self.root)
        self.rows_at = f"{self.root}/rows"

    def landed(self) -> DataFrame:
        """``(path, day)`` of all files that make up the folder now, by its log if it has one."""
        files = self.spark.read.schema(BRONZE_SCHEMA).parquet(self.bronze).inputFiles()
        listed = self.spark.createDataFrame([(path,) for path in files], "path string")
        return listed.withColumn("day", F.regexp_extract("path", f"/{DAY}=([^/]+)/", 1))

    def _covered(self, version: Version) -> DataFrame:
        lists = version.content.get("covered", [])
        if not lists:
            return self.spark.createDataFrame([], _COVERED)
        return self.spark.read.schema(_COVERED).parquet(*lists)

    def _open(self, version: Version) -> DataFrame:
        """Files that no segment stands for."""
        return self.landed().join(self._covered(version).select("path"), "path", "left_anti")

    def _rows_of(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], BRONZE_SCHEMA)
        table = self.spark.read.schema(BRONZE_SCHEMA).option("basePath", self.bronze)
        return table.parquet(*paths).select(*BRONZE_SCHEMA.names)

    def read(self) -> DataFrame:
        """All rows of the folder: compacted days, and files that came since."""
        version = self.versions.current()
        # What is open is a list of files on the driver, as in any read of the folder.
        since = self._open(version).agg(F.collect_list("path").alias("paths")).first()["paths"]
        live = version.content.get("live", {})
        return read_segments(self.spark, self.rows_at, BRONZE_SCHEMA, live).unionByName(
            self._rows_of(since)
        )

    def files_per_day(self) -> DataFrame:
        """``(day, files)``: how many files a reader opens for each day."""
        version = self.versions.current()
        live = version.content.get("live", {})
        counts = self._open(version).select("day")
        if live:
            segments = [f"{self.rows_at}/segment={s}/{DAY}={d}" for d in live for s in live[d]]
            files = self.spark.read.format("binaryFile").load(segments).select(
                F.regexp_extract("path", f"/{DAY}=([^/]+)/", 1).alias("day")
            )
            counts = counts.unionByName(files)
        return counts.groupBy("day").agg(F.count("*").alias("files"))

    def compact(self, days: Iterable[str] | None = None, least_files: int = 2) -> list[str]:
        """Write the given days, or all, as one segment each; returns the days written.

        A day with fewer than ``least_files`` files that are not in a segment is left
        alone. A day's earlier segment and its open files are read, no other day's.
        """
        before = self.versions.current()
        content = {"live": {}, "covered": [], **before.content}
        found = self._open(before)
        if days is not None:
            found = found.filter(F.col("day").isin(sorted(days)))
        many = found.groupBy("day").agg(F.collect_list("path").alias("paths")).filter(
            F.size("paths") >= least_files
        )
        # One entry per file, as the sink's own log is held by the driver.
        picked = many.agg(F.collect_list(F.struct("day", "paths")).alias("days")).first()["days"]
        if not picked:
            return []
        names_ = sorted(r["day"] for r in picked)
        paths = [p for r in picked for p in r["paths"]]
        old = read_segments(self.spark, self.rows_at, BRONZE_SCHEMA, content["live"], names_)
        segment = new_segment()
        write_segment(old.unionByName(self._rows_of(paths)), self.rows_at, segment)
        listed = self.versions.folder("covered")
        entries = [(p, r["day"]) for r in picked for p in r["paths"]]
        self.spark.createDataFrame(entries, _COVERED).coalesce(1).write.parquet(listed)
        live = with_added(without(content["live"], names_), segment, names_)
        self.versions.commit({"live": live, "covered": [*content["covered"], listed]}, before)
        return [d for d in names_ if d != NO_DAY] + [d for d in names_ if d == NO_DAY]
