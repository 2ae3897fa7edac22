"""Landing a feed as files, and the life of the queries that do it."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundflow.operators.envelope import to_envelope
from fundflow.sources.lake import DAY

Mode = Literal["continuous", "drain"]

# How often a continuous query writes files, and how many at most for one day.
INTERVAL = "30 seconds"
FILES_PER_DAY = 16
# Offsets of one topic partition that go to one file of a day.
FILE_RUN = 1 << 18

POLL_SECONDS = 5


def land_bronze(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: Mode,
    interval: str = INTERVAL,
    files_per_day: int = FILES_PER_DAY,
) -> StreamingQuery:
    """Append a stream of bronze rows to a table partitioned by day.

    ``continuous`` runs until stopped; ``drain`` takes what is there now and
    ends, which is what a scheduled step needs. Either resumes from the
    checkpoint, and no message is written twice.

    A batch writes at most ``files_per_day`` files into a day, whatever the number of
    source partitions: rows of a day are dealt to that many tasks by their place in the topic,
    a run of ``FILE_RUN`` offsets together, so that a small day is not cut into many files.
    The sink's log names every file, so choose a long ``interval`` and few files
    where messages are many, and begin a new root from time to time.
    """
    schedule = {"availableNow": True} if mode == "drain" else {"processingTime": interval}
    run = F.floor(F.col("offset") / FILE_RUN)
    slot = F.pmod(F.hash("partition", run), F.lit(files_per_day))
    return (
        df.repartition(F.col(DAY), slot)
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy(DAY)
        .trigger(**schedule)
        .start(path, checkpointLocation=checkpoint)
    )


def ingest_feed(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: Mode,
    interval: str = INTERVAL,
    files_per_day: int = FILES_PER_DAY,
) -> StreamingQuery:
    """Broker records to bronze files."""
    return land_bronze(to_envelope(stream), path, checkpoint, mode, interval, files_per_day)


def await_feeds(queries: Sequence[StreamingQuery], mode: Mode) -> None:
    """Wait for several feeds running side by side.

    A continuous run ends with the first of these queries that ends; other
    queries of the session do not matter. A drain waits for every one. The error
    of a failed query is raised; the caller stops the others.
    """
    if mode == "continuous":
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(POLL_SECONDS)
        ended = [query for query in queries if not query.isActive]
    else:
        ended = list(queries)
    for query in ended:
        query.awaitTermination()


def stop_feeds(queries: Sequence[StreamingQuery]) -> list[Exception]:
    """Stop every query, going on past errors; the errors are returned."""
    errors: list[Exception] = []
    for query in queries:
        try:
            query.stop()
        except Exception as error:  # one stuck query must not keep the rest alive
            errors.append(error)
    return errors
