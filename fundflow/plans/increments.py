"""Silver kept up to date from the new files of bronze alone.

A full run parses all of bronze again. Here a stream over bronze's files finds
those not seen before, and each batch of them is merged:

1. its messages are typed and judged as in a full run, one row per key;
2. the keys are looked up in an index of all keys met so far. The message with the
   lowest (partition, offset) holds a key, whichever batch and day it came in, so
   a repeat after midnight loses, and a message that turns up late can win;
3. rows that win a new key, and pass the rules, are added to their days; days that
   lose a row are written again without it;
4. one commit makes rows, index, counts and the number of the batch visible.

A batch that is repeated after a failure finds its number in the last commit
and is left out, or is merged anew from the same version. The result is that of
a full run over all files, whatever the batches were.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.operators.quality import MESSAGE_ORDER, judge
from fundflow.plans.silver import typed_rows
from fundflow.schemas import BRONZE_SCHEMA, Feed
from fundflow.sources.keyindex import KeyIndex
from fundflow.sources.lake import DAY, with_audit
from fundflow.sources.segments import (
    day_name,
    new_segment,
    read_segments,
    with_added,
    without,
    write_segment,
)
from fundflow.sources.snapshots import Snapshots, Version
from fundflow.sources.workspace import new_folder

_COUNTS = "feed string, rule string, rows long"
#: Segments of a day, of the index and of the counts before they are merged into one.
MOST_SEGMENTS = 8


class SilverIncrements:
    """A silver table of one feed below ``root``, with its index and counts.

    ``buckets`` is the number of buckets of the index, fixed by the first commit:
    about one for each 100 MB that the index may come to.
    """

    def __init__(self, spark: SparkSession, feed: Feed, root: str, buckets: int = 64):
        self.spark, self.feed, self.root = spark, feed, root.rstrip("/")
        self.versions = Snapshots(spark, self.root)
        self.rows_at = f"{self.root}/rows"
        self._buckets = buckets
        fields = {f.name: f for f in feed.silver.fields}
        place = [T.StructField(MESSAGE_ORDER[0], T.IntegerType()), fields["kafka_offset"]]
        rest = [fields[DAY], T.StructField("rule", T.StringType())]
        self._entry = T.StructType([*[fields[k] for k in feed.key], *place, *rest])

    # Reading

    def _state(self, version: Version) -> dict[str, Any]:
        empty = {"batches": {}, "live": {}, "index": [], "counts": [], "buckets": self._buckets}
        return {**empty, **version.content}

    def live(self, version: Version | None = None) -> dict[str, list[str]]:
        """The live segments of each day."""
        return self._state(version or self.versions.current())["live"]

    def read(self, days: Sequence[str] | None = None, version: Version | None = None) -> DataFrame:
        """The silver table of the last commit or of a given one."""
        live = self.live(version)
        return read_segments(self.spark, self.rows_at, self.feed.silver, live, days)

    def quality(self) -> DataFrame:
        """``(feed, rule, rows)`` over all messages merged so far."""
        counts = self._state(self.versions.current())["counts"]
        if not counts:
            return self.spark.createDataFrame([], _COUNTS)
        found = self.spark.read.schema(_COUNTS).parquet(*counts)
        return found.groupBy("feed", "rule").agg(F.sum("rows").alias("rows"))

    # Writing

    def advance(self, *bronze: str, files_per_batch: int | None = None) -> None:
        """Merge all files below the bronze roots that were not merged yet."""
        for path in bronze:
            source = hashlib.sha256(path.encode()).hexdigest()[:16]
            stream = self.spark.readStream.schema(BRONZE_SCHEMA)
            if files_per_batch:
                stream = stream.option("maxFilesPerTrigger", files_per_batch)

            def merge(batch: DataFrame, number: int, source: str = source) -> None:
                self.merge(batch, source, number)

            query = (
                stream.parquet(path)
                .writeStream.foreachBatch(merge)
                .option("checkpointLocation", f"{self.root}/checkpoints/{source}")
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()

    def merge(self, bronze: DataFrame, source: str, number: int) -> None:
        """Merge one batch of messages; the same source and number are merged once."""
        before = self.versions.current()
        state = self._state(before)
        if number <= state["batches"].get(source, -1):
            return
        index = KeyIndex(self.spark, self._entry, self.feed.key, MESSAGE_ORDER, state["buckets"])
        fresh = self._stored(judge(typed_rows(bronze, self.feed), self.feed), "judged")
        with index.opened(state["index"]) as segments:
            decided = self._stored(self._decide(fresh, index, segments), "decided")
            state["index"] = self._add_to_index(index, segments, state["index"], decided)
        state["counts"] = self._add_counts(state["counts"], decided)
        state["live"] = self._add_rows(state["live"], decided)
        state["batches"] = {**state["batches"], source: number}
        self.versions.commit(state, before)

    def _stored(self, frame: DataFrame, label: str) -> DataFrame:
        path = new_folder(self.spark, label)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _decide(self, fresh: DataFrame, index: KeyIndex, segments: list[DataFrame]) -> DataFrame:
        """Judged rows with the holder of their key so far, and whether they beat it."""
        names = {c: f"old_{c}" for c in self._entry.names if c not in self.feed.key}
        if segments:
            keys = fresh.filter("rule <> 'required'").select(*self.feed.key)
            held = index.holders(segments, keys).withColumnsRenamed(names)
            joined = fresh.join(held, list(self.feed.key), "left")
        else:
            types = {f.name: f.dataType for f in self._entry}
            joined = fresh.withColumns({old: F.lit(None).cast(types[c]) for c, old in names.items()})
        mine = F.struct(*MESSAGE_ORDER)
        theirs = F.struct(*[F.col(f"old_{c}") for c in MESSAGE_ORDER])
        new = F.col("old_rule").isNull()
        wins = (F.col("rule") != "required") & (new | (mine < theirs))
        return joined.withColumn("wins", wins).withColumn("known", ~new)

    def _add_to_index(
        self, index: KeyIndex, segments: list[DataFrame], paths: list[str], decided: DataFrame
    ) -> list[str]:
        winners = decided.filter("wins").select(*self._entry.names)
        added = self.versions.folder("index")
        index.write(winners, added)
        if len(paths) < MOST_SEGMENTS:
            return [*paths, added]
        whole = self.versions.folder("index")
        with index.opened([added]) as last:
            index.write(index.merged([*segments, *last]), whole)
        return [whole]

    def _add_counts(self, paths: list[str], decided: DataFrame) -> list[str]:
        """What a batch adds to the counts, less what the keys it took over had counted."""
        feed = self.feed
        messages, known, rule = F.col("messages"), F.col("known"), F.col("rule")
        complete = rule != "required"
        # Of a key not met before one message is no repeat.
        repeats = F.when(complete, messages - F.when(known, 0).otherwise(1))
        sums = {
            "read": F.sum(messages),
            "required": F.sum(F.when(~complete, messages)),
            "duplicate": F.sum(repeats),
        }
        for name in feed.rules:
            taken = F.count_if(F.col("wins") & (F.col("old_rule") == name))
            sums.setdefault(name, F.count_if(F.col("wins") & (rule == name)) - taken)
        change = decided.agg(*[F.coalesce(sums[r], F.lit(0)).alias(r) for r in feed.rules])
        path = self.versions.folder("counts")
        rows = change.unpivot([], feed.rules, "rule", "rows")
        rows.select(F.lit(feed.name).alias("feed"), "rule", "rows").write.parquet(path)
        if len(paths) < MOST_SEGMENTS:
            return [*paths, path]
        whole = self.versions.folder("counts")
        found = self.spark.read.schema(_COUNTS).parquet(*paths, path)
        total = found.groupBy("feed", "rule").agg(F.sum("rows").alias("rows"))
        total.coalesce(1).write.parquet(whole)
        return [whole]

    def _add_rows(self, live: dict[str, list[str]], decided: DataFrame) -> dict[str, list[str]]:
        """Rows that won to their days; days that lost a row, or have many segments, written again."""
        won = F.col("wins") & (F.col("rule") == "kept")
        lost = F.col("wins") & (F.col("old_rule") == "kept")
        # As many names as there are days in the batch.
        days = decided.agg(
            F.collect_set(F.when(won, day_name())).alias("won"),
            F.collect_set(F.when(lost, day_name(F.col(f"old_{DAY}")))).alias("lost"),
        ).first()
        if not days["won"] and not days["lost"]:
            return live
        again = {*days["lost"], *[d for d in days["won"] if len(live.get(d, ())) >= MOST_SEGMENTS]}
        rows = with_audit(decided.filter(won).select(*self.feed.silver_columns))
        if again:
            stay = read_segments(self.spark, self.rows_at, self.feed.silver, live, sorted(again))
            gone = decided.filter(lost).select(*self.feed.key)
            rows = rows.unionByName(stay.join(gone, list(self.feed.key), "left_anti"))
        segment = new_segment()
        write_segment(rows, self.rows_at, segment)
        filled = days["won"]
        if again:
            # A day may have lost its last row.
            day = T.StructType([f for f in self.feed.silver if f.name == DAY])
            held = self.spark.read.schema(day).parquet(f"{self.rows_at}/segment={segment}")
            filled = held.agg(F.collect_set(day_name()).alias("days")).first()["days"]
        return with_added(without(live, again), segment, sorted(filled))
