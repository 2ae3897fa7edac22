"""Fund roll-up over days and its rank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.functions import exact_sum, mean_of


def value_band(column: str) -> str:
    """SQL for a number that never falls as ``column`` rises, from a bounded set.

    Bands are steps of about one percent in size, on either side of zero. Over
    all doubles there are fewer than 140,000 of them, whatever the data. A
    missing value has no band; NaN, which sorts above all numbers, the highest.
    """
    step = f"floor(log2(least(abs({column}), 1e300D) * 10000D + 1D) * 64D)"
    return f"CASE WHEN {column} < 0 THEN -{step} WHEN {column} >= 0 THEN {step} END"


def rank_descending(rows: DataFrame, by: str, out: str = "rank") -> DataFrame:
    """SQL ``rank()`` over one global descending order, missing values last.

    A window without a partition would move all rows into one task. The rank of
    a value is one more than the number of rows above it, so it is counted from
    the distinct values: rows above in its own band, by a window per band, plus
    rows in higher bands, by a running total over the bounded list of bands,
    which is therefore safe to broadcast (a few MB at most). Ties collapse
    before the first shuffle, and a band of values with four decimals holds few
    distinct ones: about a hundred times its lower bound. ``rows`` is read twice; pass a persisted or
    written frame if it is costly.
    """
    above = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    ranks = rows.sparkSession.sql(
        f"""
        WITH spread AS (
          SELECT `{by}` AS _value, count(*) AS n, {value_band(f"`{by}`")} AS band
          FROM {{rows}} GROUP BY `{by}`
        ),
        bands AS (
          SELECT band AS of_band,
                 sum(sum(n)) OVER (ORDER BY band DESC NULLS LAST {above}) AS n_higher
          FROM spread GROUP BY band
        ),
        within AS (
          SELECT _value, band,
                 sum(n) OVER (PARTITION BY band ORDER BY _value DESC NULLS LAST {above}) AS n_above
          FROM spread
        )
        SELECT /*+ BROADCAST(bands) */ _value,
               CAST(1 + coalesce(n_higher, 0) + coalesce(n_above, 0) AS INT) AS `{out}`
        FROM within JOIN bands ON band <=> of_band
        """,
        rows=rows,
    )
    return rows.join(ranks, F.col(by).eqNullSafe(F.col("_value"))).drop("_value")


def fund_totals(days: DataFrame) -> DataFrame:
    """Every fund with its means over days, from ``fund_days``."""
    measures = {
        "daily_return_pct": "avg_daily_return_pct",
        "avg_nav": "avg_nav",
        "nav_volatility": "avg_volatility",
    }
    sums = days.groupBy("scheme_code", "scheme_name").agg(
        *[exact_sum(m).alias(f"{m}_sum") for m in measures],
        *[F.count(m).alias(f"{m}_n") for m in measures],
        F.max("daily_return_pct").alias("best_daily_return_pct"),
        F.count("*").alias("trading_days"),
    )
    # Means are taken in a step of their own, which keeps the generated code of each small.
    means = [mean_of(F.col(f"{m}_sum"), F.col(f"{m}_n"), 4).alias(out) for m, out in measures.items()]
    return sums.select(
        "scheme_code",
        "scheme_name",
        means[0],
        "best_daily_return_pct",
        means[1],
        means[2],
        "trading_days",
    )


def top_funds(days: DataFrame) -> DataFrame:
    """Fund totals with their rank, from ``fund_days``.

    Ranked by average daily return alone; ties share a rank and leave a gap.
    ``days`` is read twice (see ``rank_descending``).
    """
    return rank_descending(fund_totals(days), by="avg_daily_return_pct")
