"""The same queries as plain SQL, for an independent engine to check the results."""

from __future__ import annotations

from barflow.plans.queries import ENRICHED
from barflow.schema import BAR_COLUMNS, MONITOR_COLUMNS

USER_DAY = """
bars AS (
  SELECT 'U' || user_id AS symbol, CAST(date_trunc('day', ts) AS TIMESTAMP) AS "timestamp",
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS volume
  FROM events GROUP BY 1, 2)"""

DIRTY_DAY = USER_DAY.replace("bars AS", "clean AS", 1) + """,
bars AS (
  SELECT CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 7 = 0 THEN 'USER-NUMBER-' || substr(symbol, 2)
              ELSE symbol END AS symbol, "timestamp", open, high, low, close,
         CASE WHEN day("timestamp") % 5 <> 0 THEN volume END AS volume FROM clean)"""

_TIES = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity"
SUPPLIER_WEEK = f"""
bars AS (
  SELECT 'S' || l_suppkey AS symbol, CAST(date_trunc('week', l_shipdate) AS TIMESTAMP) AS "timestamp",
         first(l_extendedprice / l_quantity ORDER BY {_TIES}) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         last(l_extendedprice / l_quantity ORDER BY {_TIES}) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2)"""

ENRICH = """
history AS (
  SELECT *, lag(close) OVER s AS prev_close, lag(high) OVER s AS prev_high,
         lag(low) OVER s AS prev_low, lag(volume) OVER s AS prev_volume,
         avg(volume) OVER (s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS avg_volume_20
  FROM bars WINDOW s AS (PARTITION BY symbol ORDER BY "timestamp")),
moves AS (
  SELECT *, abs(close - open) AS body_size, high - greatest(open, close) AS upper_shadow,
         least(open, close) - low AS lower_shadow, close - prev_close AS price_change,
         CASE WHEN prev_close <> 0 THEN (close - prev_close) / prev_close * 100::DOUBLE
              ELSE 0::DOUBLE END AS price_change_pct,
         CASE WHEN avg_volume_20 > 0 THEN volume / avg_volume_20 ELSE 1::DOUBLE END AS volume_ratio
  FROM history),
enriched AS (
  SELECT *, coalesce(volume_ratio > 1.5::DOUBLE, false) AS volume_spike,
         coalesce(price_change > 0 AND volume_ratio > 1.5::DOUBLE, false) AS high_volume_up,
         coalesce(price_change < 0 AND volume_ratio > 1.5::DOUBLE, false) AS high_volume_down
  FROM moves)"""

RULES = """
ruled AS (
  SELECT *, CASE
    WHEN price_change_pct > 1.0::DOUBLE AND volume_ratio > 1.5::DOUBLE AND close > prev_high
      THEN 'breakout'
    WHEN price_change_pct < -1.0::DOUBLE AND volume_ratio > 1.5::DOUBLE AND close < prev_low
      THEN 'breakdown'
    WHEN close > prev_high AND open < prev_close AND volume_ratio > 1.2::DOUBLE
         AND body_size > (high - low) * 0.6::DOUBLE THEN 'engulf_bull'
    WHEN close < prev_low AND open > prev_close AND volume_ratio > 1.2::DOUBLE
         AND body_size > (high - low) * 0.6::DOUBLE THEN 'engulf_bear'
    WHEN price_change_pct > 0.5::DOUBLE AND volume_ratio > 1.3::DOUBLE AND high_volume_up
      THEN 'accumulation'
    WHEN price_change_pct < -0.5::DOUBLE AND volume_ratio > 1.3::DOUBLE AND high_volume_down
      THEN 'distribution' END AS rule
  FROM enriched),
classified AS (
  SELECT *, CASE WHEN rule IN ('breakout', 'engulf_bull', 'accumulation') THEN 'BUY'
                 WHEN rule IS NOT NULL THEN 'SELL' ELSE 'HOLD' END AS signal,
         CASE WHEN volume_ratio > 2.5::DOUBLE THEN 'VERY_STRONG'
              WHEN volume_ratio > 2.0::DOUBLE THEN 'STRONG'
              WHEN volume_ratio > 1.5::DOUBLE THEN 'MODERATE'
              WHEN volume_ratio > 1.2::DOUBLE THEN 'WEAK' ELSE 'VERY_WEAK' END AS signal_strength
  FROM ruled),
signals AS (
  SELECT *, close * CASE signal WHEN 'BUY' THEN 0.98::DOUBLE ELSE 1.02::DOUBLE END AS stop_loss_price,
         close * CASE signal WHEN 'BUY' THEN 1.03::DOUBLE ELSE 0.97::DOUBLE END AS take_profit_price
  FROM classified WHERE signal IN ('BUY', 'SELL')),
risked AS (
  SELECT *, CASE signal
    WHEN 'BUY' THEN (take_profit_price - close) / nullif(close - stop_loss_price, 0)
    ELSE (close - take_profit_price) / nullif(stop_loss_price - close, 0) END AS risk_reward_ratio
  FROM signals)"""

# Decimals round half up on the printed value, as the table sink does.
_MONEY = [("open", "open_price"), ("high", "high_price"), ("low", "low_price"), ("close", "close_price")]


def _names(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def _decimal(column: str, digits: int) -> str:
    return f"TRY_CAST(CAST({column} AS VARCHAR) AS DECIMAL({digits}, 2))"


def _query(bars: str, steps: list[str], select: str) -> str:
    return "WITH " + ",".join([bars, *steps]) + "\n" + select


def _weekly(select: str, *steps: str) -> str:
    return _query(SUPPLIER_WEEK, list(steps), select)


def _daily(select: str, *steps: str) -> str:
    return _query(USER_DAY, list(steps), select)


def _decided_by(rule: str) -> str:
    return _weekly(
        'SELECT symbol, "timestamp", open, close, prev_close, prev_high, prev_low, volume_ratio, '
        f"price_change_pct, signal FROM classified WHERE rule = '{rule}'", ENRICH, RULES,
    )


_EVENT_BARS = """
event_bars AS (
  SELECT 'U' || user_id AS symbol, ts AS "timestamp", value AS open, value AS high, value AS low,
         value AS close, CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, event_type, event_id
  FROM events)"""

_SIGNAL_REASON = "CASE " + " ".join(
    f"WHEN {c} IS NOT NULL AND {_decimal(c, d)} IS NULL THEN '{c} out of range'"
    for c, d in [
        ("open", 10), ("high", 10), ("low", 10), ("close", 10),
        ("stop_loss_price", 10), ("take_profit_price", 10),
        ("volume_ratio", 5), ("price_change_pct", 5), ("risk_reward_ratio", 5),
    ]
) + " END"

_CHECKED = f"""
checked AS (
  SELECT *, CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL OR volume IS NULL
                 THEN 'missing value' WHEN length(symbol) > 10 THEN 'symbol too long'
                 ELSE {_SIGNAL_REASON} END AS reject_reason
  FROM risked)"""

_WATCH_LIST = "symbol IN (SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal > 0)"


_ISO = """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f')"""

# The year before which a round of stored signals ends, and in which it is created.
_ROUND_END = 'CASE WHEN year("timestamp") < 1995 THEN 1995 WHEN year("timestamp") < 1997 THEN 1997 ELSE 2100 END'


def oracle_sql() -> dict[str, str]:
    bars, monitor, enriched = _names(BAR_COLUMNS), _names(MONITOR_COLUMNS), _names(ENRICHED)
    at = 'symbol, "timestamp"'
    return {
        "bars_user_day": _daily(f"SELECT {bars} FROM bars"),
        "bars_supplier_week": _weekly(f"SELECT {bars} FROM bars"),
        "latest_bar_per_symbol": _weekly(
            f"SELECT {bars} FROM bars "
            'QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) = 1'
        ),
        "bars_symbol_subset": _weekly(f"SELECT {bars} FROM bars WHERE {_WATCH_LIST}"),
        "json_round_trip": _weekly(f"SELECT {bars} FROM bars"),
        "parse_messages": f"""WITH {_EVENT_BARS}
            SELECT {bars}, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS fetch_time,
                   "timestamp" AS kafka_timestamp FROM event_bars""",
        "topic_messages": _daily(f"""SELECT nullif(symbol, '') AS key,
            '{{' || coalesce('"symbol":"' || symbol || '",', '') || '"timestamp":"' || {_ISO} || '","open":' || open
              || ',"high":' || high || ',"low":' || low || ',"close":' || close || ',"volume":' || volume
              || ',"fetch_time":"' || strftime("timestamp" + INTERVAL 90 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || '"}}' AS value,
            "timestamp" + INTERVAL 2 MINUTE AS "timestamp" FROM (SELECT * REPLACE (
              CASE CAST(substr(symbol, 2) AS BIGINT) % 7 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE symbol END AS symbol)
            FROM bars)"""),
        "bar_rejects": f"""WITH {_EVENT_BARS}, bodies AS (
            SELECT *, strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS sent,
              '"open":' || value || ',"high":' || value || ',"low":' || value || ',"close":' || value AS prices
            FROM event_bars JOIN (SELECT event_id, value FROM events) USING (event_id)),
            sent AS (SELECT *, '{{' || CASE WHEN event_type = 'signup' THEN '' ELSE '"symbol":"' || symbol || '",' END
              || '"timestamp":"' || CASE WHEN event_type = 'view' THEN 'not a time' ELSE sent END || '",' || prices
              || CASE WHEN event_type <> 'click' THEN ',"volume":' || volume ELSE '' END || '}}' AS whole FROM bodies)
            SELECT "timestamp" AS kafka_timestamp,
                   CASE WHEN event_type NOT IN ('error', 'signup') THEN symbol END AS symbol,
                   CASE WHEN event_type <> 'error' THEN close END AS close,
                   CASE event_type WHEN 'error' THEN left(whole, 20) ELSE whole END AS body,
                   CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'no symbol'
                        ELSE 'no timestamp' END AS reject_reason
            FROM sent WHERE event_type IN ('error', 'signup', 'view')""",
        "bars_accepted": f"""WITH {_EVENT_BARS}
            SELECT symbol, "timestamp", open, high, low, close,
                   CASE WHEN event_type <> 'click' THEN volume END AS volume FROM event_bars
            WHERE event_type NOT IN ('error', 'signup', 'view')""",
        "prev_bar": _weekly(
            f"SELECT {at}, prev_close, prev_high, prev_low, prev_volume FROM enriched", ENRICH
        ),
        "trailing_avg_volume": _weekly(f"SELECT {at}, volume, avg_volume_20 FROM enriched", ENRICH),
        "candle_shape": _weekly(
            f"SELECT {at}, body_size, upper_shadow, lower_shadow FROM enriched", ENRICH
        ),
        "price_change": _weekly(
            f"SELECT {at}, close, prev_close, price_change, price_change_pct FROM enriched", ENRICH
        ),
        "volume_metrics": _weekly(
            f"SELECT {at}, volume, volume_ratio, volume_spike, high_volume_up, high_volume_down "
            "FROM enriched", ENRICH,
        ),
        "enriched_bars": _weekly(f"SELECT {enriched} FROM enriched", ENRICH),
        "enriched_bars_user_day": _daily(f"SELECT {enriched} FROM enriched", ENRICH),
        "enriched_bars_chunked": _weekly(f"SELECT {enriched} FROM enriched", ENRICH),
        **{
            name: _weekly(
                f"SELECT {enriched} FROM enriched WHERE \"timestamp\" >= TIMESTAMP '1996-01-01' "
                "AND \"timestamp\" < TIMESTAMP '1998-01-01'", ENRICH,
            )
            for name in ("enriched_range", "enriched_range_lookback")
        },
        **{
            f"signal_{rule}": _decided_by(rule)
            for rule in ("breakout", "breakdown", "engulf_bull", "engulf_bear", "accumulation",
                         "distribution")
        },
        "signal_all": _weekly(f"SELECT {at}, signal FROM classified", ENRICH, RULES),
        "signal_strength": _weekly(
            f"SELECT {at}, volume_ratio, signal_strength FROM classified", ENRICH, RULES
        ),
        "signal_context_flat": _weekly(
            f"SELECT {at}, volume_ratio AS volume_multiple, price_change_pct AS price_move_pct, "
            "body_size AS candle_body_size, upper_shadow + lower_shadow AS total_shadows, "
            "volume_spike AS volume_anomaly FROM classified", ENRICH, RULES,
        ),
        "signal_actionable": _weekly(
            f"SELECT {at}, close, signal, signal_strength FROM signals", ENRICH, RULES
        ),
        "risk_levels": _weekly(
            f"SELECT {at}, signal, close, stop_loss_price, take_profit_price, "
            "round(risk_reward_ratio, 9) AS risk_reward_ratio FROM risked", ENRICH, RULES,
        ),
        "signal_monitor": _daily(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "signal_monitor_messages": _daily(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "signal_stamps": _daily(
            "SELECT symbol, count(*) AS signals, count(*) AS stamped, count(*) AS in_order, "
            "CAST(1 AS BIGINT) AS decision_times FROM risked GROUP BY symbol", ENRICH, RULES),
        "signal_monitor_week": _weekly(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "signal_monitor_chunked": _weekly(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "trading_signals_rows": _daily(
            f"SELECT {at}, "
            + ", ".join(f"{_decimal(c, 10)} AS {name}" for c, name in _MONEY)
            + ", volume, signal, signal_strength, "
            + ", ".join(
                f"{_decimal(c, d)} AS {c}" for c, d in [
                    ("volume_ratio", 5), ("price_change_pct", 5), ("stop_loss_price", 10),
                    ("take_profit_price", 10), ("risk_reward_ratio", 5)]
            )
            + " FROM checked WHERE reject_reason IS NULL", ENRICH, RULES, _CHECKED,
        ),
        "signal_rejects": _daily(
            f"SELECT {at}, signal, reject_reason FROM checked WHERE reject_reason IS NOT NULL",
            ENRICH, RULES, _CHECKED,
        ),
        "stock_data_rows": _weekly(
            f"SELECT {at}, " + ", ".join(f"{_decimal(c, 10)} AS {name}" for c, name in _MONEY)
            + ', volume, "timestamp" AS fetch_time FROM bars'
        ),
        "signals_by_type": _weekly(
            f"SELECT {monitor} FROM risked WHERE signal = 'SELL'", ENRICH, RULES
        ),
        "signals_symbol_range": _weekly(
            f"SELECT {monitor} FROM risked WHERE \"timestamp\" >= TIMESTAMP '1997-01-01' "
            f"AND \"timestamp\" < TIMESTAMP '1998-01-01' AND {_WATCH_LIST}", ENRICH, RULES,
        ),
        "signals_since": _weekly(
            f'SELECT {monitor} FROM risked WHERE "timestamp" >= '
            '(SELECT max("timestamp") FROM risked) - INTERVAL 90 DAY', ENRICH, RULES,
        ),
        "signals_of_symbol_all_time": _weekly(f"SELECT {monitor} FROM risked WHERE symbol = 'S7'", ENRICH, RULES),
        "signals_created_since": _weekly(
            f"SELECT {monitor}, make_timestamp({_ROUND_END}, 1, 1, 0, 0, 0) AS created_at FROM risked "
            f"WHERE {_ROUND_END} >= 1997", ENRICH, RULES),
        "signals_appended_twice": _weekly(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "signals_numbered": _weekly(
            f'SELECT row_number() OVER (ORDER BY {_ROUND_END}, symbol, "timestamp", signal) AS id, '
            f"{at}, signal FROM risked", ENRICH, RULES),
        "bar_field_errors": f"""WITH {_EVENT_BARS}, bodies AS (
            SELECT *, '{{"symbol":"' || symbol || '","timestamp":"'
              || CASE event_type WHEN 'view' THEN 'not a time' ELSE {_ISO} END || '","open":' || open || ',"high":'
              || CASE event_type WHEN 'purchase' THEN 'true' ELSE CAST(high AS VARCHAR) END || ',"low":' || low || ',"close":'
              || CASE event_type WHEN 'click' THEN '"' || symbol || '"' ELSE CAST(close AS VARCHAR) END || ',"volume":' || volume
              || CASE event_type WHEN 'signup' THEN '.5' ELSE '' END || '}}' AS body FROM event_bars)
            SELECT "timestamp" AS kafka_timestamp, body,
              CASE event_type WHEN 'view' THEN 'timestamp' WHEN 'purchase' THEN 'high' WHEN 'click' THEN 'close'
                ELSE 'volume' END AS field,
              CASE event_type WHEN 'view' THEN 'not a time' WHEN 'purchase' THEN 'true' WHEN 'click' THEN symbol
                ELSE volume || '.5' END AS raw
            FROM bodies WHERE event_type IN ('view', 'purchase', 'click', 'signup')""",
        "stream_late_bars": _daily(
            f'SELECT {bars}, CASE WHEN user % 5 = 0 AND "timestamp" <= missed THEN missed END AS watermark FROM ('
            'SELECT *, CAST(substr(symbol, 2) AS BIGINT) AS user, (max("timestamp") FILTER '
            "(CAST(substr(symbol, 2) AS BIGINT) % 5 <> 0) OVER ()) - INTERVAL 3 DAY AS missed FROM bars)"),
        "stream_bars_upserted": _daily(f"SELECT {bars} FROM bars"),
        "stream_bars_user_day": _daily(f"SELECT {bars} FROM bars"),
        "stream_signal_monitor": _daily(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "live_signal_store": _daily(f"SELECT {monitor} FROM risked", ENRICH, RULES),
        "stream_enriched_rounds": _weekly(f"SELECT {enriched} FROM enriched", ENRICH),
        "bars_coerced": _weekly(f"SELECT {bars} FROM bars"),
        "last_copies_of_ties": _daily(
            'SELECT symbol, "timestamp", open, high, low, close + 1 AS close, volume FROM bars'
        ),
        "signal_monitor_dirty_messages": _query(
            DIRTY_DAY, [ENRICH, RULES], f"SELECT {monitor} FROM risked"),
        "stock_data_rejects": _query(DIRTY_DAY, [], f"""SELECT {at}, CASE
            WHEN length(symbol) > 10 THEN 'symbol too long' WHEN volume IS NULL THEN 'no volume'
            ELSE 'no fetch time' END AS reject_reason,
            '{{"symbol":"' || symbol || '","timestamp":"' || {_ISO} || '","open":' || open || ',"high":' || high
              || ',"low":' || low || ',"close":' || close
              || CASE WHEN volume IS NULL THEN '' ELSE ',"volume":' || volume END
              || CASE WHEN length(symbol) % 3 = 0 THEN '' ELSE ',"fetch_time":"' || {_ISO} || '"' END || '}}' AS body
            FROM bars
            WHERE length(symbol) > 10 OR volume IS NULL OR length(symbol) % 3 = 0"""),
    }
