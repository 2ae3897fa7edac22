"""Table contracts: the columns and types every layer promises."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING, BINARY = T.StringType(), T.BinaryType()
INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Field names and types of the messages on the wire.
NAV_SCHEMA = _table(
    timestamp=STRING,
    scheme_code=INT,
    scheme_name=STRING,
    nav=DOUBLE,
)
TXN_SCHEMA = _table(
    transaction_id=STRING,
    timestamp=STRING,
    scheme_code=INT,
    transaction_type=STRING,
    amount=DOUBLE,
    status=STRING,
)
NAV_TOPIC = "nav_raw"
TXN_TOPIC = "txn_raw"
TRANSACTION_TYPES = ("BUY", "SELL", "REDEEM")

# What a message broker hands over, and the layers built on it.
KAFKA_SCHEMA = _table(
    key=BINARY,
    value=BINARY,
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=TIMESTAMP,
)
BRONZE_SCHEMA = _table(
    key=STRING,
    json_payload=STRING,
    topic=STRING,
    partition=INT,
    offset=LONG,
    timestamp=TIMESTAMP,
    ingestion_date=DATE,
)
SILVER_NAV_SCHEMA = _table(
    scheme_code=INT,
    scheme_name=STRING,
    nav=DOUBLE,
    event_timestamp=TIMESTAMP,
    ingestion_date=DATE,
    kafka_topic=STRING,
    kafka_offset=LONG,
    processed_at=TIMESTAMP,
)
SILVER_TXN_SCHEMA = _table(
    transaction_id=STRING,
    scheme_code=INT,
    transaction_type=STRING,
    amount=DOUBLE,
    status=STRING,
    event_timestamp=TIMESTAMP,
    ingestion_date=DATE,
    kafka_topic=STRING,
    kafka_offset=LONG,
    processed_at=TIMESTAMP,
)
GOLD_SCHEMAS = {
    "gold_aum_by_fund": _table(
        scheme_code=INT,
        ingestion_date=DATE,
        net_aum=DOUBLE,
        total_buy_amount=DOUBLE,
        total_sell_amount=DOUBLE,
        total_transactions=LONG,
        processed_at=TIMESTAMP,
    ),
    "gold_nav_performance": _table(
        scheme_code=INT,
        scheme_name=STRING,
        ingestion_date=DATE,
        opening_nav=DOUBLE,
        closing_nav=DOUBLE,
        min_nav=DOUBLE,
        max_nav=DOUBLE,
        avg_nav=DOUBLE,
        nav_updates=LONG,
        daily_return_pct=DOUBLE,
        processed_at=TIMESTAMP,
    ),
    "gold_txn_volume": _table(
        ingestion_date=DATE,
        transaction_type=STRING,
        scheme_code=INT,
        txn_count=LONG,
        total_amount=DOUBLE,
        avg_amount=DOUBLE,
        min_amount=DOUBLE,
        max_amount=DOUBLE,
        processed_at=TIMESTAMP,
    ),
    "gold_top_funds": _table(
        scheme_code=INT,
        scheme_name=STRING,
        avg_daily_return_pct=DOUBLE,
        best_daily_return_pct=DOUBLE,
        avg_nav=DOUBLE,
        avg_volatility=DOUBLE,
        trading_days=LONG,
        rank=INT,
        processed_at=TIMESTAMP,
    ),
}


@dataclass(frozen=True)
class Feed:
    """Everything that sets one feed apart from the other."""

    name: str
    topic: str
    folder: str
    payload: T.StructType
    silver: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]
    measure: str
    domain_column: str | None = None
    domain: tuple[str, ...] = ()

    @property
    def silver_columns(self) -> list[str]:
        """Published columns, without the audit time added at the sink."""
        return [name for name in self.silver.names if name != "processed_at"]

    @property
    def judged_columns(self) -> list[str]:
        """Columns that decide which rule a row meets."""
        domain = [self.domain_column] if self.domain_column else []
        return list(dict.fromkeys([*self.key, *self.required, self.measure, *domain]))

    @property
    def rules(self) -> list[str]:
        """Quality rules in the order they are applied to a row."""
        checks = ["required", "duplicate", "not_positive"]
        if self.domain_column:
            checks.append("bad_domain")
        return ["read", *checks, "kept"]


NAV = Feed(
    name="nav",
    topic=NAV_TOPIC,
    folder="nav_data",
    payload=NAV_SCHEMA,
    silver=SILVER_NAV_SCHEMA,
    key=("scheme_code", "event_timestamp"),
    required=("scheme_code", "nav", "event_timestamp"),
    measure="nav",
)
TXN = Feed(
    name="txn",
    topic=TXN_TOPIC,
    folder="transaction_data",
    payload=TXN_SCHEMA,
    silver=SILVER_TXN_SCHEMA,
    key=("transaction_id",),
    required=("transaction_id", "scheme_code", "amount", "event_timestamp"),
    measure="amount",
    domain_column="transaction_type",
    domain=TRANSACTION_TYPES,
)
