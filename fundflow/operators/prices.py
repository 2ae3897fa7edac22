"""Opening and closing prices, daily performance and volatility."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundflow.functions import (
    add_moments,
    add_up,
    billionths,
    daily_return,
    exact_sum,
    mean_of,
    moments,
    sample_deviation,
)


def fund_day_states(nav: DataFrame, day_col: str = "ingestion_date") -> DataFrame:
    """Price ticks reduced to one state per fund, name and day, not yet rounded.

    All buffers are of fixed width and merge: map-side within one aggregate, and
    by ``merge_fund_days`` between states that were stored.
    """
    price, at = F.col("nav"), F.col("event_timestamp")
    ticks = nav.withColumn("_whole", billionths("nav"))
    return ticks.groupBy("scheme_code", "scheme_name", day_col).agg(
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
        F.min_by(price, at).alias("first_nav"),
        F.max_by(price, at).alias("last_nav"),
        F.min(price).alias("min_nav"),
        F.max(price).alias("max_nav"),
        exact_sum("nav").alias("nav_total"),
        F.count("nav").alias("navs"),
        moments("nav", "_whole").alias("nav_moments"),
        F.count("*").alias("nav_updates"),
    )


def merge_fund_days(states: DataFrame, day_col: str = "ingestion_date") -> DataFrame:
    """States of the same fund, name and day as one: what all their ticks together would give."""
    return states.groupBy("scheme_code", "scheme_name", day_col).agg(
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
        F.min_by("first_nav", "first_at").alias("first_nav"),
        F.max_by("last_nav", "last_at").alias("last_nav"),
        F.min("min_nav").alias("min_nav"),
        F.max("max_nav").alias("max_nav"),
        F.when(F.sum("navs") > 0, add_up("nav_total")).alias("nav_total"),
        F.sum("navs").alias("navs"),
        add_moments("nav_moments").alias("nav_moments"),
        F.sum("nav_updates").alias("nav_updates"),
    )


def fund_days(nav: DataFrame, day_col: str = "ingestion_date") -> DataFrame:
    """Price ticks reduced to one published row per fund, name and day."""
    return published_fund_days(fund_day_states(nav, day_col), day_col)


def published_fund_days(
    by_name: DataFrame, day_col: str = "ingestion_date", stored: bool = False
) -> DataFrame:
    """Prices, means and deviations of states.

    Opening and closing price belong to the fund and day: a fund that is renamed
    within a day has a row per name, all with the same two prices. A window over
    the names of a fund and day finds them in one pass. Where the states are
    ``stored``, and so cheap to read twice, they are found by an aggregate that
    merges map-side, and joined back; then a feed that puts a counter into the
    name of a fund does not send a whole fund day to one task.
    """
    keys = ["scheme_code", day_col]
    if stored:
        prices = by_name.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
            F.min_by("first_nav", "first_at").alias("_opening"),
            F.max_by("last_nav", "last_at").alias("_closing"),
        )
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        by_name = by_name.join(prices, same[0] & same[1])
        opening, closing = F.col("_opening"), F.col("_closing")
    else:
        # No order: min_by and max_by need one exchange and one sort on the keys.
        whole_day = Window.partitionBy(*keys)
        opening = F.min_by("first_nav", "first_at").over(whole_day)
        closing = F.max_by("last_nav", "last_at").over(whole_day)
    return by_name.select(
        "scheme_code",
        "scheme_name",
        day_col,
        F.round(opening, 4).alias("opening_nav"),
        F.round(closing, 4).alias("closing_nav"),
        F.round("min_nav", 4).alias("min_nav"),
        F.round("max_nav", 4).alias("max_nav"),
        mean_of(F.col("nav_total"), F.col("navs"), 4).alias("avg_nav"),
        sample_deviation(F.col("nav_moments")).alias("nav_volatility"),
        "nav_updates",
    ).withColumn("daily_return_pct", daily_return(F.col("opening_nav"), F.col("closing_nav")))


def nav_performance(days: DataFrame) -> DataFrame:
    """Performance per fund and day, from ``fund_days``."""
    return days.drop("nav_volatility")


def fund_daily_returns(days: DataFrame) -> DataFrame:
    """Return and volatility per fund and day, from ``fund_days``.

    Volatility is the sample deviation: NULL on a day with a single tick.
    """
    return days.drop("min_nav", "max_nav", "nav_updates")


def open_close(nav: DataFrame, day_col: str = "ingestion_date") -> DataFrame:
    """Every tick with the opening and closing price of its fund and day.

    Written as a join of the ticks with the reduced fund days instead of a
    window over the ticks, so a fund day with a third of all ticks can be split
    between tasks: Spark broadcasts the reduced side when its measured size
    allows it and splits skewed partitions of the ticks otherwise.
    """
    ticks = nav.select("scheme_code", day_col, "event_timestamp", "nav")
    at = F.col("event_timestamp")
    days = ticks.groupBy(
        F.col("scheme_code").alias("_fund"), F.col(day_col).alias("_day")
    ).agg(
        F.min_by("nav", at).alias("opening_nav"),
        F.max_by("nav", at).alias("closing_nav"),
    )
    same_day = F.col("scheme_code").eqNullSafe(F.col("_fund")) & F.col(day_col).eqNullSafe(
        F.col("_day")
    )
    return ticks.join(days, same_day).drop("_fund", "_day")
