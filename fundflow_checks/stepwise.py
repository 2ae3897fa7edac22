"""The same results computed step by step, in SQL: the yardstick for bench.py.

One action per reported count, every duplicate and every window over all ticks,
each gold table from silver on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundflow.schemas import Feed
from fundflow.sources.lake import with_audit


def _view(frame: DataFrame, name: str) -> None:
    frame.createOrReplaceTempView(name)


def silver_steps(typed: DataFrame, feed: Feed, path: str) -> dict[str, int]:
    """Write a silver table; each quality figure is a job of its own."""
    spark = typed.sparkSession
    _view(typed, "step_read")
    complete = " AND ".join(f"{name} IS NOT NULL" for name in feed.required)
    _view(spark.sql(f"SELECT * FROM step_read WHERE {complete}"), "step_complete")
    _view(spark.table("step_complete").dropDuplicates(list(feed.key)), "step_distinct")
    _view(spark.sql(f"SELECT * FROM step_distinct WHERE {feed.measure} > 0"), "step_positive")
    last = "step_positive"
    if feed.domain_column:
        allowed = ", ".join(f"'{value}'" for value in feed.domain)
        text = f"SELECT * FROM step_positive WHERE {feed.domain_column} IN ({allowed})"
        _view(spark.sql(text), "step_kept")
        last = "step_kept"
    names = ["step_read", "step_complete", "step_distinct", "step_positive", last]
    counts = {name: spark.table(name).count() for name in dict.fromkeys(names)}
    kept = with_audit(spark.table(last).select(*feed.silver_columns))
    kept.write.partitionBy("ingestion_date").parquet(path, mode="overwrite")
    return counts


_RETURN = "round(try_divide(closing_nav - opening_nav, opening_nav) * 100, 4)"
_DAYS = f"""
  SELECT *, {_RETURN} AS daily_return_pct FROM (
    SELECT scheme_code, scheme_name, ingestion_date,
           round(any_value(o), 4) AS opening_nav, round(any_value(c), 4) AS closing_nav,
           round(min(nav), 4) AS min_nav, round(max(nav), 4) AS max_nav,
           round(avg(nav), 4) AS avg_nav, round(stddev_samp(nav), 4) AS nav_volatility,
           count(*) AS nav_updates
    FROM (
      SELECT *, first_value(nav) OVER (PARTITION BY scheme_code, ingestion_date
                                       ORDER BY event_timestamp) AS o,
             first_value(nav) OVER (PARTITION BY scheme_code, ingestion_date
                                    ORDER BY event_timestamp DESC) AS c
      FROM silver_nav_files)
    GROUP BY scheme_code, scheme_name, ingestion_date)"""

GOLD_STEPS = {
    "gold_aum_by_fund": """
      SELECT scheme_code, ingestion_date,
             round(sum(CASE transaction_type WHEN 'BUY' THEN amount
                       WHEN 'SELL' THEN -amount ELSE 0 END), 2) AS net_aum,
             round(sum(if(transaction_type = 'BUY', amount, 0)), 2) AS total_buy_amount,
             round(sum(if(transaction_type = 'SELL', amount, 0)), 2) AS total_sell_amount,
             count(*) AS total_transactions
      FROM silver_txn_files GROUP BY ALL ORDER BY ingestion_date, scheme_code""",
    "gold_nav_performance": f"""
      SELECT * EXCEPT (nav_volatility) FROM ({_DAYS})
      ORDER BY ingestion_date, daily_return_pct DESC""",
    "gold_txn_volume": """
      SELECT ingestion_date, transaction_type, scheme_code, count(*) AS txn_count,
             round(sum(amount), 2) AS total_amount, round(avg(amount), 2) AS avg_amount,
             round(min(amount), 2) AS min_amount, round(max(amount), 2) AS max_amount
      FROM silver_txn_files GROUP BY ingestion_date, transaction_type, scheme_code
      ORDER BY ingestion_date, transaction_type, scheme_code""",
    "gold_top_funds": f"""
      SELECT *, rank() OVER (ORDER BY avg_daily_return_pct DESC) AS rank FROM (
        SELECT scheme_code, scheme_name, round(avg(daily_return_pct), 4) AS avg_daily_return_pct,
               round(max(daily_return_pct), 4) AS best_daily_return_pct,
               round(avg(avg_nav), 4) AS avg_nav, round(avg(nav_volatility), 4) AS avg_volatility,
               count(*) AS trading_days
        FROM ({_DAYS}) GROUP BY scheme_code, scheme_name)
      ORDER BY rank""",
}


# Windows over every tick; the first row of every key in a stated order.
TICK_STEPS = {
    "gold_open_close": """
      SELECT scheme_code, ingestion_date, event_timestamp, nav,
             first_value(nav) OVER (PARTITION BY scheme_code, ingestion_date
                                    ORDER BY event_timestamp) AS opening_nav,
             first_value(nav) OVER (PARTITION BY scheme_code, ingestion_date
                                    ORDER BY event_timestamp DESC) AS closing_nav
      FROM silver_nav_files""",
    "lineitem_txn_dedup": """
      SELECT transaction_id, scheme_code, transaction_type, amount, ingestion_date FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY
                    l_shipdate, l_partkey, l_suppkey, l_quantity, amount, l_discount, l_tax) AS n
        FROM silver_txn_files) WHERE n = 1""",
}
#: Queries of the library with the steps that give the same rows, but for the last digits of sums.
QUERY_STEPS = {
    **{name: name for name in (*GOLD_STEPS, *TICK_STEPS)},
    "lineitem_txn_volume": "gold_txn_volume",
    "lineitem_net_flow": "gold_aum_by_fund",
}


def query_steps(spark: SparkSession, name: str, nav: DataFrame, txn: DataFrame) -> DataFrame:
    """One query by its steps, from silver rows."""
    _view(nav, "silver_nav_files")
    _view(txn, "silver_txn_files")
    return spark.sql((GOLD_STEPS | TICK_STEPS)[QUERY_STEPS[name]])


def gold_steps(spark: SparkSession, nav: DataFrame, txn: DataFrame) -> dict[str, DataFrame]:
    """The gold tables, each with a plan of its own."""
    _view(nav, "silver_nav_files")
    _view(txn, "silver_txn_files")
    return {name: spark.sql(text) for name, text in GOLD_STEPS.items()}
