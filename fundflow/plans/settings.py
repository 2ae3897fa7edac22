"""Session settings that suit a given amount of data, for the caller to apply."""

from __future__ import annotations

import math

_MB = 1024**2


def cluster_settings(
    shuffle_bytes: int, cores: int, partition_bytes: int = 200 * _MB
) -> dict[str, str]:
    """Settings for a session that shuffles ``shuffle_bytes`` in its widest stage.

    That stage is the deduplication of a feed: about the size of the typed feed.
    Partitions start out small enough for one core's share of memory and are
    merged at run time where they turn out smaller; skewed ones are split. Never
    fewer than two per core, so that no core idles on a small input.
    """
    partitions = max(2 * cores, math.ceil(shuffle_bytes / partition_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * _MB),
        # A stage whose map outputs went with an executor is computed again.
        "spark.stage.maxConsecutiveAttempts": "10",
        # A slow copy of a task must not write to a database beside the first.
        "spark.speculation": "false",
    }
