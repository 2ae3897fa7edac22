"""Where a stream stood, to begin another one there."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from fundflow.sources.files import names, text

# Fixed value: a log entry of a checkpoint or of a file sink, the latter also compacted.
_ENTRY = re.compile(r"^(\d+)(\.compact)?$")


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(m[1]) for n, _ in names(spark, folder) if (m := _ENTRY.match(n)))


def last_batch(spark: SparkSession, checkpoint: str, sink: str | None = None) -> int | None:
    """The last batch whose rows readers see, or None.

    A batch counts once the checkpoint's log of commits has it, or the log of the
    file sink that it wrote to. The sink is first: after a failure between the
    two, the batch is visible but not yet committed.
    """
    done = _numbers(spark, f"{checkpoint}/commits")
    if sink:
        done += _numbers(spark, f"{sink}/_spark_metadata")
    return max(done, default=None)


def committed_offsets(spark: SparkSession, checkpoint: str, sink: str | None = None) -> list[str]:
    """The end of the last visible batch, one JSON text per source; none if there is none.

    For a topic this is just what ``startingOffsets`` takes. A partition that was added
    to the topic since is not in it; add it with -2, its beginning.
    """
    batch = last_batch(spark, checkpoint, sink)
    if batch is None:
        return []
    lines = text(spark, f"{checkpoint}/offsets/{batch}").splitlines()
    # A version, the batch's settings, then the sources in order.
    return [line for line in lines[2:] if line.strip() and line.strip() != "-"]
