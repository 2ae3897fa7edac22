"""All layers in one application."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fundflow.operators.quality import enough_rows
from fundflow.plans.gold import shared_gold_tables
from fundflow.plans.quarantine import KEPT, split_silver
from fundflow.plans.silver import build_silver
from fundflow.schemas import NAV, TXN, Feed
from fundflow.sources.kafka import kafka_stream
from fundflow.sources.lake import read_bronze, read_silver, silver_path
from fundflow.sources.warehouse import Warehouse, side_by_side
from fundflow.streaming.landing import (
    FILES_PER_DAY,
    INTERVAL,
    Mode,
    await_feeds,
    ingest_feed,
    stop_feeds,
)
from fundflow.streaming.offsets import committed_offsets

FEEDS = (NAV, TXN)
_UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


@dataclass(frozen=True)
class LakeConfig:
    """Where the layers live. ``root`` is any URI the cluster can write.

    ``topic_options`` goes to the topic readers (see ``kafka_options``). Bronze is
    landed below ``period``, a name of the caller's, and read from that and
    ``earlier`` periods: a new period begins a new file log and a new checkpoint. Its
    topics begin where the last of ``earlier`` ended, so name that one last. With
    ``keep_rejected`` silver also holds the messages that broke a rule.
    """

    root: str
    warehouse: Warehouse
    servers: str = ""
    topic_options: Mapping[str, str] = field(default_factory=dict)
    min_funds: int = 0
    silver_root: str | None = None
    period: str = ""
    earlier: Sequence[str] = ()
    interval: str = INTERVAL
    files_per_day: int = FILES_PER_DAY
    keep_rejected: bool = False

    def _below(self, top: str, feed: Feed, period: str) -> str:
        return f"{self.root}/{top}/{feed.folder}" + (f"-{period}" if period else "")

    def bronze(self, feed: Feed) -> str:
        return self._below("bronze", feed, self.period)

    def all_bronze(self, feed: Feed) -> list[str]:
        return [self._below("bronze", feed, p) for p in (*self.earlier, self.period)]

    def checkpoint(self, feed: Feed) -> str:
        return self._below("checkpoints", feed, self.period)

    @property
    def silver(self) -> str:
        return self.silver_root or f"{self.root}/silver"

    @property
    def silver_part(self) -> str:
        """The folder within a silver table that holds the kept rows."""
        return KEPT if self.keep_rejected else ""


@dataclass(frozen=True)
class RunReport:
    """What a run did: quality counts per feed, and the funds it ranked."""

    quality: dict[str, dict[str, int]]
    total_funds: int


def starting_offsets(spark: SparkSession, cfg: LakeConfig, feed: Feed) -> str:
    """Where a feed's topic begins in this period: at the end of the last one, if there was one."""
    if not cfg.earlier:
        return "earliest"
    last = replace(cfg, period=cfg.earlier[-1], earlier=())
    ended = committed_offsets(spark, last.checkpoint(feed), last.bronze(feed))
    return ended[0] if ended else "earliest"


def topic_streams(spark: SparkSession, cfg: LakeConfig) -> dict[str, DataFrame]:
    """One stream per feed, from the message broker."""
    return {
        feed.name: kafka_stream(
            spark,
            feed.topic,
            cfg.servers,
            starting=starting_offsets(spark, cfg, feed),
            extra=cfg.topic_options,
        )
        for feed in FEEDS
    }


def require_utc(spark: SparkSession) -> None:
    """Days are those of the session's zone, so it has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC:
        raise ValueError(f"spark.sql.session.timeZone is {zone}, not UTC")


def run_bronze(cfg: LakeConfig, streams: dict[str, DataFrame], mode: Mode = "drain") -> None:
    """Land all feeds side by side. If one cannot start or fails, none is left running.

    A query that will not stop is an error of its own, or a note on the first one.
    """
    for stream in streams.values():
        require_utc(stream.sparkSession)
    queries: list[StreamingQuery] = []
    try:
        for feed in FEEDS:
            query = ingest_feed(
                streams[feed.name],
                cfg.bronze(feed),
                cfg.checkpoint(feed),
                mode,
                cfg.interval,
                cfg.files_per_day,
            )
            queries.append(query)
        await_feeds(queries, mode)
    except BaseException as error:
        for other in stop_feeds(queries):
            error.add_note(f"a query did not stop: {other}")
        raise
    if stuck := stop_feeds(queries):
        raise stuck[0]


def run_silver(spark: SparkSession, cfg: LakeConfig) -> dict[str, dict[str, int]]:
    """Rewrite both silver tables, one pass per feed."""
    require_utc(spark)

    def build(feed: Feed) -> tuple[str, dict[str, int]]:
        bronze = read_bronze(spark, cfg.all_bronze(feed))
        write = split_silver if cfg.keep_rejected else build_silver
        return feed.name, write(bronze, feed, silver_path(cfg.silver, feed.folder))

    return dict(side_by_side(spark, build, FEEDS))


def run_gold(spark: SparkSession, cfg: LakeConfig) -> int:
    """Replace the gold tables, then check the ranking as it can be read back."""
    nav, txn = read_silver(spark, cfg.silver, part=cfg.silver_part)
    with shared_gold_tables(nav, txn) as tables:
        cfg.warehouse.publish(spark, tables)
    return enough_rows(cfg.warehouse.count(spark, "gold_top_funds"), cfg.min_funds)


def run_all(
    spark: SparkSession, cfg: LakeConfig, streams: dict[str, DataFrame] | None = None
) -> RunReport:
    """Drain the feeds, rebuild silver and gold, verify; the first failure ends it."""
    require_utc(spark)
    run_bronze(cfg, streams or topic_streams(spark, cfg))
    quality = run_silver(spark, cfg)
    return RunReport(quality=quality, total_funds=run_gold(spark, cfg))
