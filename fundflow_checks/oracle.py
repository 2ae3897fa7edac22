"""The same queries in SQL, written without JSON and without Spark."""

from __future__ import annotations

# What the messages hold, one row per message, before any rule.
_COPIES = """
copies AS (
  SELECT e.*, e.event_id % 50 AS m, c.copy, e.event_id * 2 + c.copy AS kafka_offset,
         ts::date AS ingestion_date,
         CASE WHEN e.event_id % 50 <> 13 THEN date_trunc('second', ts)::timestamp END AS event_second,
         CASE WHEN e.event_id % 50 = 17 THEN -(value + c.copy)::decimal(18,2)
              WHEN e.event_id % 50 <> 11 THEN (value + c.copy)::decimal(18,2) END AS v
  FROM events e JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR e.event_id % 50 = 19
)"""
_KIND = """CASE WHEN m = 23 THEN NULL WHEN event_type IN ('purchase', 'view') THEN 'BUY'
              WHEN event_type = 'signup' THEN 'SELL' WHEN event_type = 'click' THEN 'REDEEM'
              ELSE 'SWITCH' END"""


def _nav_typed(name: str = "'Fund ' || user_id") -> str:
    return f"""{_COPIES},
typed AS (
  SELECT CASE WHEN m <> 7 THEN user_id::int END AS scheme_code,
         CASE WHEN m <> 7 THEN {name} END AS scheme_name,
         CASE WHEN m <> 7 THEN v::double END AS nav,
         CASE WHEN m <> 7 THEN event_second END AS event_timestamp,
         ingestion_date, 'nav_raw' AS kafka_topic, kafka_offset
  FROM copies
),
complete AS (
  SELECT * FROM typed
  WHERE scheme_code IS NOT NULL AND nav IS NOT NULL AND event_timestamp IS NOT NULL
),
distinct_rows AS (
  SELECT * FROM complete QUALIFY
    row_number() OVER (PARTITION BY scheme_code, event_timestamp ORDER BY kafka_offset) = 1
),
silver AS (SELECT * FROM distinct_rows WHERE nav > 0)"""


_NAV = _nav_typed()
_TXN = f"""{_COPIES},
typed AS (
  SELECT CASE WHEN m NOT IN (3, 7) THEN 'TXN_' || event_id END AS transaction_id,
         CASE WHEN m NOT IN (5, 7) THEN user_id::int END AS scheme_code,
         CASE WHEN m <> 7 THEN {_KIND} END AS transaction_type,
         CASE WHEN m <> 7 THEN v::double END AS amount,
         CASE WHEN m <> 7 THEN
           CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END END AS status,
         CASE WHEN m <> 7 THEN event_second END AS event_timestamp,
         ingestion_date, 'txn_raw' AS kafka_topic, kafka_offset
  FROM copies
),
complete AS (
  SELECT * FROM typed WHERE transaction_id IS NOT NULL AND scheme_code IS NOT NULL
    AND amount IS NOT NULL AND event_timestamp IS NOT NULL
),
distinct_rows AS (
  SELECT * FROM complete QUALIFY
    row_number() OVER (PARTITION BY transaction_id ORDER BY kafka_offset) = 1
),
silver AS (
  SELECT * FROM distinct_rows
  WHERE amount > 0 AND transaction_type IN ('BUY', 'SELL', 'REDEEM')
)"""


def _rsum(x: str, places: int) -> str:
    return f"round(sum(({x})::decimal(28,10)), {places})::double"


def _ravg(x: str, places: int) -> str:
    """Mean in whole numbers: half up means twice the total plus the count, by twice the count."""
    total = f"sum((({x})::decimal(28,10) * 10000000000)::hugeint)::hugeint"
    twice = f"2 * abs({total}) * {10**places}"
    n = f"(count({x})::hugeint * 10000000000)"
    whole = f"(({twice} + {n}) // nullif(2 * {n}, 0))"
    return f"(sign({total}) * ({whole})::double / {10**places}::double)"


def _r(x: str, places: int) -> str:
    """Round a double half-up by its shortest decimal text, as Spark's round does.

    A cast to decimal(28,10) would round twice: 225.78124999999997, the return
    from 1.28 to 4.17, would become 225.7813.
    """
    return f"round(({x})::varchar::decimal(38,18), {places})::double"


def _deviation(x: str) -> str:
    """Sample deviation half-up to four places, from whole hundredths and their squares.

    A deviation d reaches a limit of b ten-thousandths if n * squares - sum ** 2, in
    hundredths, is at least (b / 100) ** 2 * n * (n - 1); limits are halves of a step.
    """
    k = f"(({x})::decimal(18,2) * 100)::hugeint"
    n = f"count({x})::hugeint"
    spread = f"({n} * sum({k} * {k})::hugeint - sum({k})::hugeint * sum({k})::hugeint)"
    guess = f"round(sqrt({spread}::double / ({n} * ({n} - 1))::double) * 100)::hugeint"
    limit = f"(2 * {guess} {{}} 1)"
    test = f"{spread} * 40000 >= {limit} * {limit} * {n} * ({n} - 1)"
    return (
        f"CASE WHEN count({x}) > 1 THEN (CASE WHEN {test.format('+', '+')} THEN {guess} + 1"
        f" WHEN {guess} > 0 AND NOT ({test.format('-', '-')}) THEN {guess} - 1"
        f" ELSE {guess} END)::double / 10000 END"
    )


_RETURN = (
    "CASE WHEN opening_nav <> 0 THEN "
    + _r("(closing_nav - opening_nav) / opening_nav * 100", 4)
    + " END AS daily_return_pct"
)
_TICKS = """
ticks AS (
  SELECT *, first_value(nav) OVER (w ORDER BY event_timestamp) AS o,
         first_value(nav) OVER (w ORDER BY event_timestamp DESC) AS c
  FROM silver WINDOW w AS (PARTITION BY scheme_code, ingestion_date)
)"""
_DAYS = f"""{_TICKS},
day_prices AS (
  SELECT scheme_code, scheme_name, ingestion_date,
         {_r("any_value(o)", 4)} AS opening_nav, {_r("any_value(c)", 4)} AS closing_nav,
         {_r("min(nav)", 4)} AS min_nav, {_r("max(nav)", 4)} AS max_nav,
         {_ravg("nav", 4)} AS avg_nav, {_r("stddev_samp(nav)", 4)} AS nav_volatility,
         count(*) AS nav_updates
  FROM ticks GROUP BY ALL
),
days AS (SELECT *, {_RETURN} FROM day_prices)"""
_FUNDS = f"""{_DAYS},
funds AS (
  SELECT scheme_code, scheme_name, {_ravg("daily_return_pct", 4)} AS avg_daily_return_pct,
         max(daily_return_pct) AS best_daily_return_pct, {_ravg("avg_nav", 4)} AS avg_nav,
         {_ravg("nav_volatility", 4)} AS avg_volatility, count(*) AS trading_days
  FROM days GROUP BY scheme_code, scheme_name
)"""
_PERFORMANCE = "SELECT * EXCLUDE (nav_volatility) FROM days"

_LINES = """
lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_suppkey::int AS scheme_code,
         CASE l_returnflag WHEN 'A' THEN 'BUY' WHEN 'N' THEN 'SELL' ELSE 'REDEEM' END
           AS transaction_type,
         l_extendedprice AS amount, l_shipdate::date AS ingestion_date, lineitem.*
  FROM lineitem
)"""


def _net_flow(source: str) -> str:
    buy = "CASE WHEN transaction_type = 'BUY' THEN amount ELSE 0 END"
    sell = "CASE WHEN transaction_type = 'SELL' THEN amount ELSE 0 END"
    net = (
        "CASE transaction_type WHEN 'BUY' THEN amount::decimal(28,10) "
        "WHEN 'SELL' THEN -amount::decimal(28,10) ELSE 0 END"
    )
    return f"""SELECT scheme_code, ingestion_date, {_rsum(net, 2)} AS net_aum,
      {_rsum(buy, 2)} AS total_buy_amount, {_rsum(sell, 2)} AS total_sell_amount,
      count(*) AS total_transactions
    FROM {source} GROUP BY scheme_code, ingestion_date"""


def _volume(source: str) -> str:
    return f"""SELECT ingestion_date, transaction_type, scheme_code, count(*) AS txn_count,
      {_rsum("amount", 2)} AS total_amount, {_ravg("amount", 2)} AS avg_amount,
      {_r("min(amount)", 2)} AS min_amount, {_r("max(amount)", 2)} AS max_amount
    FROM {source} GROUP BY ALL"""


def _quality(feed: str, typed: str, last_rule: str) -> str:
    good_type = "transaction_type IN ('BUY', 'SELL', 'REDEEM')"
    rules = {
        "read": "(SELECT count(*) FROM typed)",
        "required": "(SELECT count(*) FROM typed) - (SELECT count(*) FROM complete)",
        "duplicate": "(SELECT count(*) FROM complete) - (SELECT count(*) FROM distinct_rows)",
        "not_positive": f"(SELECT count(*) FROM distinct_rows WHERE {last_rule} <= 0)",
        "kept": "(SELECT count(*) FROM silver)",
    }
    if feed == "txn":
        rules["bad_domain"] = (
            "(SELECT count(*) FROM distinct_rows WHERE amount > 0"
            f" AND ({good_type}) IS NOT TRUE)"
        )
    rows = [
        f"SELECT '{feed}' AS feed, '{rule}' AS rule, ({count})::bigint AS rows"
        for rule, count in rules.items()
    ]
    return f"WITH {typed} " + " UNION ALL ".join(rows)


_NAV_TEXT = """'{"timestamp":"' || CASE WHEN m = 13 THEN 'garbage'
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
  || '","scheme_code":' || user_id || ',"scheme_name":"Fund ' || user_id || '"'
  || coalesce(',"nav":' || v, '') || '}'"""
_TXN_TEXT = f"""'{{' || CASE WHEN m <> 3 THEN '"transaction_id":"TXN_' || event_id || '",' ELSE '' END
  || '"timestamp":"' || CASE WHEN m = 13 THEN 'garbage'
    ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
  || '","scheme_code":' || CASE WHEN m = 5 THEN '"' || user_id || '"' ELSE user_id::varchar END
  || coalesce(',"transaction_type":"' || ({_KIND}) || '"', '')
  || coalesce(',"amount":' || v, '')
  || ',"status":"' || CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END || '"}}'"""


def _bronze(topic: str, text: str) -> str:
    return f"""SELECT NULL::varchar AS key,
      CASE WHEN m = 7 THEN 'not json' ELSE {text} END AS json_payload,
      '{topic}' AS topic, 0::int AS partition, kafka_offset AS "offset",
      ts AS "timestamp", ingestion_date FROM copies"""


_NAV_BRONZE = _bronze("nav_raw", _NAV_TEXT)
_TXN_BRONZE = _bronze("txn_raw", _TXN_TEXT)


def _rejected(typed: str, feed: str, required: str, key: str, measure: str, last: str) -> str:
    """Incomplete messages one by one, and the first message of each key that breaks a rule."""
    topic, text = (("nav_raw", _NAV_TEXT), ("txn_raw", _TXN_TEXT))[feed == "txn"]
    return f"""WITH {typed},
      sent AS (SELECT kafka_offset, CASE WHEN m = 7 THEN 'not json' ELSE {text} END AS json_payload
               FROM copies),
      firsts AS (
        SELECT *, count(*) OVER (PARTITION BY {key}) AS messages FROM complete
        QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY kafka_offset) = 1),
      bad AS (
        SELECT 'required' AS rule, kafka_offset, ingestion_date, 1 AS messages FROM typed
        WHERE NOT ({required})
        UNION ALL
        SELECT CASE WHEN {measure} <= 0 THEN 'not_positive' ELSE 'bad_domain' END,
               kafka_offset, ingestion_date, messages FROM firsts WHERE NOT ({last}))
    SELECT rule, '{topic}' AS kafka_topic, 0::int AS kafka_partition, kafka_offset, ingestion_date,
           messages::bigint AS messages, json_payload
    FROM bad JOIN sent USING (kafka_offset)"""


def _drift(feed: str, promised: dict[str, str]) -> str:
    """Fields of the messages by DuckDB's own JSON functions."""
    topic, text = (("nav_raw", _NAV_TEXT), ("txn_raw", _TXN_TEXT))[feed == "txn"]
    names = ", ".join(f"('{n}', '{kinds}')" for n, kinds in promised.items())
    return f"""WITH {_COPIES}, bronze AS ({_bronze(topic, text)}),
      read AS (
        SELECT ingestion_date, json_payload AS p, json_valid(json_payload) AS valid,
               CASE WHEN json_valid(json_payload) THEN json_type(json_payload) END AS whole
        FROM bronze),
      objects AS (SELECT * FROM read WHERE whole = 'OBJECT'),
      fields AS (SELECT ingestion_date, p, unnest(json_keys(p)) AS field FROM objects),
      kinds AS (
        SELECT ingestion_date, field,
               CASE json_type(p, '$."' || field || '"')
                 WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'HUGEINT' THEN 'integer'
                 WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
                 WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' ELSE 'array' END AS kind
        FROM fields),
      promised(field, allowed) AS (VALUES {names}),
      counted AS (
        SELECT ingestion_date, field, kind, count(*) AS messages FROM kinds GROUP BY ALL
        UNION ALL
        SELECT ingestion_date, NULL, CASE WHEN valid THEN 'no object' ELSE 'unreadable' END, count(*)
        FROM read WHERE whole IS DISTINCT FROM 'OBJECT' GROUP BY ALL),
      absent AS (
        SELECT o.ingestion_date, field, n - coalesce(seen, 0) AS messages
        FROM (SELECT ingestion_date, count(*) AS n FROM objects GROUP BY ALL) o CROSS JOIN promised
        LEFT JOIN (SELECT ingestion_date, field, count(*) AS seen FROM fields GROUP BY ALL) s
          USING (ingestion_date, field))
    SELECT '{feed}' AS feed, c.ingestion_date, c.field, c.kind, c.messages,
           CASE WHEN c.field IS NULL THEN 'unreadable' WHEN p.field IS NULL THEN 'unknown'
                WHEN list_contains(string_split(allowed, ' '), kind) THEN 'expected'
                WHEN kind = 'null' THEN 'empty' ELSE 'other kind' END AS verdict
    FROM counted c LEFT JOIN promised p USING (field)
    UNION ALL
    SELECT '{feed}', ingestion_date, field, 'missing', messages, 'missing' FROM absent WHERE messages > 0"""


def _silver_and_gold(prefix: str, cte: str) -> str:
    """Rename the shared CTE names so that both feeds fit in one statement."""
    for name in ("copies", "typed", "complete", "distinct_rows", "silver"):
        cte = cte.replace(f"{name} AS (", f"{prefix}_{name} AS (")
        cte = cte.replace(f"FROM {name}", f"FROM {prefix}_{name}")
    return cte


_BOTH = f"{_silver_and_gold('nav', _NAV)}, {_silver_and_gold('txn', _TXN)}"


def oracle_sql() -> dict[str, str]:
    shared = "scheme_code, event_timestamp, ingestion_date, kafka_topic, kafka_offset"
    ranked = "rank() OVER (ORDER BY avg_daily_return_pct DESC NULLS LAST)::int AS rank"
    nav_counts = {
        "bronze_nav": "nav_typed",
        "bronze_txn": "txn_typed",
        "silver_nav": "nav_silver",
        "silver_txn": "txn_silver",
        "gold_aum_by_fund": "(SELECT DISTINCT scheme_code, ingestion_date FROM txn_silver)",
        "gold_nav_performance": (
            "(SELECT DISTINCT scheme_code, scheme_name, ingestion_date FROM nav_silver)"
        ),
        "gold_txn_volume": (
            "(SELECT DISTINCT scheme_code, transaction_type, ingestion_date FROM txn_silver)"
        ),
        "gold_top_funds": "(SELECT DISTINCT scheme_code, scheme_name FROM nav_silver)",
    }
    layer_rows = " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", count(*) AS rows FROM {source}"
        for name, source in nav_counts.items()
    )
    def first(table: str, order: str, n: int | None = None) -> str:
        rows = f"SELECT *, row_number() OVER (ORDER BY {order})::int AS position FROM ({table})"
        return f"{rows} QUALIFY position <= {n}" if n else rows

    by_date = "SELECT ingestion_date, count(*) AS count FROM silver GROUP BY ALL"
    by_type = f"""SELECT ingestion_date, transaction_type, count(*) AS count,
                 {_rsum("amount", 2)} AS total_amount
          FROM silver GROUP BY ingestion_date, transaction_type"""
    top = f"SELECT *, {ranked} FROM funds"
    quality = _quality("nav", _NAV, "nav"), _quality("txn", _TXN, "amount")
    by_day = "ingestion_date NULLS FIRST"
    by_fund = "scheme_code NULLS FIRST"
    by_name = f"{by_fund}, scheme_name NULLS FIRST"
    by_kind = f"{by_day}, transaction_type NULLS FIRST"
    best = f"{by_day}, daily_return_pct DESC NULLS LAST, {by_name}"
    shown = {
        "summary_txn_sample": f"WITH {_TXN} SELECT * FROM silver ORDER BY transaction_id LIMIT 5",
        "summary_nav_by_date_shown": f"WITH {_NAV} {first(by_date, by_day)}",
        "summary_txn_by_date_type_shown": f"WITH {_TXN} {first(by_type, by_kind)}",
        "shown_aum_by_fund": f"WITH {_TXN} {first(_net_flow('silver'), f'{by_day}, {by_fund}', 10)}",
        "shown_nav_performance": f"WITH {_NAV}, {_DAYS} {first(_PERFORMANCE, best, 10)}",
        "shown_txn_volume": f"WITH {_TXN} {first(_volume('silver'), f'{by_kind}, {by_fund}', 10)}",
        "shown_top_funds": f"WITH {_NAV}, {_FUNDS} {first(top, f'rank, {by_name}', 20)}",
    }
    layers = {
        "silver_nav_roundtrip": f"WITH {_NAV} SELECT * FROM silver",
        "silver_txn_roundtrip": f"WITH {_TXN} SELECT * FROM silver",
        "layers_silver_nav": f"WITH {_NAV} SELECT * FROM silver",
        "layers_silver_txn": f"WITH {_TXN} SELECT * FROM silver",
        "layers_gold_aum_by_fund": f"WITH {_TXN} {_net_flow('silver')}",
        "layers_gold_nav_performance": f"WITH {_NAV}, {_DAYS} {_PERFORMANCE}",
        "layers_gold_txn_volume": f"WITH {_TXN} {_volume('silver')}",
        "layers_gold_top_funds": f"WITH {_NAV}, {_FUNDS} {top}",
        "layers_quality": f"SELECT * FROM ({quality[0]}) UNION ALL SELECT * FROM ({quality[1]})",
    }
    good_type = "transaction_type IN ('BUY', 'SELL', 'REDEEM')"
    nav_needs = "scheme_code IS NOT NULL AND nav IS NOT NULL AND event_timestamp IS NOT NULL"
    txn_needs = (
        "transaction_id IS NOT NULL AND scheme_code IS NOT NULL AND amount IS NOT NULL"
        " AND event_timestamp IS NOT NULL"
    )
    nav_fields = {
        "timestamp": "string", "scheme_code": "integer", "scheme_name": "string",
        "nav": "integer number",
    }
    txn_fields = {
        "transaction_id": "string", "timestamp": "string", "scheme_code": "integer",
        "transaction_type": "string", "amount": "integer number", "status": "string",
    }
    steps = {
        "bronze_compacted": f"WITH {_COPIES} {_NAV_BRONZE}",
        "rejected_nav": _rejected(
            _NAV, "nav", nav_needs, "scheme_code, event_timestamp", "nav", "nav > 0"
        ),
        "rejected_txn": _rejected(
            _TXN, "txn", txn_needs, "transaction_id", "amount",
            f"amount > 0 AND ({good_type}) IS TRUE",
        ),
        "drift_nav": _drift("nav", nav_fields),
        "drift_txn": _drift("txn", txn_fields),
        "positions_aum_by_fund": f"""WITH {_TXN}
          SELECT * REPLACE (position::bigint AS position)
          FROM ({first(_net_flow('silver'), f'{by_day}, {by_fund}')})""",
        "positions_nav_performance": f"""WITH {_NAV}, {_DAYS}
          SELECT * REPLACE (position::bigint AS position) FROM ({first(_PERFORMANCE, best)})""",
        "positions_lineitem": f"""WITH {_LINES}
          SELECT transaction_id, amount, row_number() OVER (ORDER BY amount DESC, transaction_id,
            l_shipdate, l_partkey, l_suppkey, l_quantity, l_discount, l_tax) AS position
          FROM lines""",
        "increments_silver_nav": f"WITH {_NAV} SELECT * FROM silver",
        "increments_silver_txn": f"WITH {_TXN} SELECT * FROM silver",
        "increments_quality": f"SELECT * FROM ({quality[0]}) UNION ALL SELECT * FROM ({quality[1]})",
        "increments_gold_aum_by_fund": f"WITH {_TXN} {_net_flow('silver')}",
        "increments_gold_nav_performance": f"WITH {_NAV}, {_DAYS} {_PERFORMANCE}",
        "increments_gold_txn_volume": f"WITH {_TXN} {_volume('silver')}",
        "increments_gold_top_funds": f"WITH {_NAV}, {_FUNDS} {top}",
        "gold_volatility": f"""WITH {_NAV}
          SELECT scheme_code, scheme_name, ingestion_date, {_deviation("nav")} AS nav_volatility,
                 count(*) AS nav_updates
          FROM silver GROUP BY ALL""",
        "lineitem_volatility": f"""WITH {_LINES}
          SELECT scheme_code, {_deviation("amount")} AS amount_volatility
          FROM lines GROUP BY scheme_code""",
    }
    renamed = _nav_typed("'Fund ' || user_id || '-' || (event_id % 3)")
    return shown | layers | steps | {
        "bronze_envelope": f"WITH {_COPIES} {_NAV_BRONZE} UNION ALL {_TXN_BRONZE}",
        "bronze_stream_landing": f"WITH {_COPIES} {_NAV_BRONZE}",
        "bronze_stream_restart": f"""WITH {_COPIES}
          SELECT ingestion_date, count(*) AS messages FROM copies GROUP BY ALL""",
        "bronze_stream_two_feeds": f"""WITH {_COPIES}
          SELECT topic, ingestion_date, count(*) AS messages
          FROM copies, (VALUES ('nav_raw'), ('txn_raw')) t(topic) GROUP BY ALL""",
        "silver_nav_parsed": f"WITH {_NAV} SELECT * FROM typed",
        "silver_txn_parsed": f"WITH {_TXN} SELECT * FROM typed",
        "silver_nav_not_null": f"WITH {_NAV} SELECT * FROM complete",
        "silver_txn_not_null": f"WITH {_TXN} SELECT * FROM complete",
        "silver_nav_dedup": f"WITH {_NAV} SELECT * FROM distinct_rows",
        "silver_txn_dedup": f"WITH {_TXN} SELECT * FROM distinct_rows",
        "silver_nav": f"WITH {_NAV} SELECT * FROM silver",
        "silver_txn": f"WITH {_TXN} SELECT * FROM silver",
        "silver_nav_quality": _quality("nav", _NAV, "nav"),
        "silver_txn_quality": _quality("txn", _TXN, "amount"),
        "silver_counts": f"""WITH {_BOTH}
          SELECT 'nav' AS feed, count(*) AS rows FROM nav_silver
          UNION ALL SELECT 'txn' AS feed, count(*) AS rows FROM txn_silver""",
        "silver_partition_roundtrip": f"""WITH {_BOTH}
          SELECT {shared}, nav AS measure FROM nav_silver
          UNION ALL SELECT {shared}, amount AS measure FROM txn_silver""",
        "summary_nav_by_date": f"""WITH {_NAV}
          SELECT ingestion_date, count(*) AS count FROM silver GROUP BY ALL""",
        "summary_txn_by_date_type": f"""WITH {_TXN}
          SELECT ingestion_date, transaction_type, count(*) AS count,
                 {_rsum("amount", 2)} AS total_amount
          FROM silver GROUP BY ingestion_date, transaction_type""",
        "summary_nav_sample": f"""WITH {_NAV}
          SELECT * FROM silver ORDER BY scheme_code, event_timestamp LIMIT 5""",
        "gold_open_close": f"""WITH {_NAV}, {_TICKS}
          SELECT scheme_code, ingestion_date, event_timestamp, nav,
                 o AS opening_nav, c AS closing_nav FROM ticks""",
        "gold_aum_by_fund": f"WITH {_TXN} {_net_flow('silver')}",
        "gold_nav_performance": f"WITH {_NAV}, {_DAYS} {_PERFORMANCE}",
        "gold_nav_performance_renamed": f"WITH {renamed}, {_DAYS} {_PERFORMANCE}",
        "gold_txn_volume": f"WITH {_TXN} {_volume('silver')}",
        "gold_fund_daily_returns": f"""WITH {_NAV}, {_DAYS}
          SELECT * EXCLUDE (min_nav, max_nav, nav_updates) FROM days""",
        "gold_top_funds": f"WITH {_NAV}, {_FUNDS} SELECT *, {ranked} FROM funds",
        "gold_verify_count": f"""WITH {_NAV}
          SELECT count(*) AS total_funds
          FROM (SELECT DISTINCT scheme_code, scheme_name FROM silver)""",
        "layers_end_to_end": f"WITH {_BOTH} {layer_rows}",
        "lineitem_txn_dedup": f"""WITH {_LINES}
          SELECT transaction_id, scheme_code, transaction_type, amount, ingestion_date
          FROM lines QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY
            l_shipdate, l_partkey, l_suppkey, l_quantity, amount, l_discount, l_tax,
            transaction_type) = 1""",
        "lineitem_txn_volume": f"WITH {_LINES} {_volume('lines')}",
        "lineitem_net_flow": f"WITH {_LINES} {_net_flow('lines')}",
    }
