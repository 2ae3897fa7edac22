"""A run over all layers that leaves out what is up to date.

A ledger below the lake's root names, for each layer, the files it was made from
and the files it made. A later run compares: while both are the same, the layer is
left as it is, so a run that failed in gold begins again with gold.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from fundflow.plans import medallion
from fundflow.plans.medallion import FEEDS, LakeConfig, RunReport, require_utc
from fundflow.sources.files import listing_digest
from fundflow.sources.lake import silver_path
from fundflow.sources.snapshots import Snapshots


def _record(ledger: Snapshots, layer: str, entry: dict[str, Any]) -> None:
    before = ledger.current()
    ledger.commit({**before.content, layer: entry}, before)


def resume_all(
    spark: SparkSession, cfg: LakeConfig, streams: dict[str, DataFrame] | None = None
) -> RunReport:
    """Like ``run_all``, from the first layer whose files changed.

    Bronze is drained in any case; its stream knows what it has. Gold is made again
    when silver's files are others than those it was last made from; whether
    somebody else changed the gold tables is not looked at.
    """
    require_utc(spark)
    ledger = Snapshots(spark, f"{cfg.root}/ledger")
    medallion.run_bronze(cfg, streams or medallion.topic_streams(spark, cfg))
    bronze = [path for feed in FEEDS for path in cfg.all_bronze(feed)]
    silver = [silver_path(cfg.silver, feed.folder) for feed in FEEDS]
    known = ledger.current().content
    made_from, made = listing_digest(spark, *bronze), listing_digest(spark, *silver)
    entry = known.get("silver", {})
    if (entry.get("from"), entry.get("made")) != (made_from, made):
        quality = medallion.run_silver(spark, cfg)
        made = listing_digest(spark, *silver)
        entry = {"from": made_from, "made": made, "quality": quality}
        _record(ledger, "silver", entry)
    gold = known.get("gold", {})
    if gold.get("from") != made:
        gold = {"from": made, "funds": medallion.run_gold(spark, cfg)}
        _record(ledger, "gold", gold)
    return RunReport(quality=entry["quality"], total_funds=gold["funds"])
