"""DuckDB reference SQL for the query catalog (the driver's correctness gate).

Each statement reads the driver's pre-registered views directly.  The CTE
blocks below restate, in plain SQL, the fixed mapping of ``events`` and
``lineitem`` onto market feeds (see ``sources/adapters.py``) and the silver
models, so a query and its oracle share only the input tables.
"""

from __future__ import annotations

# events -> bronze rows (+ typed payload fields the oracle reads directly).
EVENTS_BRONZE = """
ev AS (
  SELECT event_id, user_id, event_type, value, props, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ms,
         CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 'raw.trades.v1'
              WHEN event_type = 'view' THEN 'raw.depth.v1'
              WHEN event_type = 'error' THEN 'dlq.trades' END AS topic
  FROM events
),
rec AS (
  SELECT ev.*, c.copy
  FROM ev JOIN (VALUES (0), (1), (2)) AS c(copy) ON c.copy = 0 OR ev.event_id % 10 = 0
  WHERE ev.topic IS NOT NULL
),
bronze_x AS (
  SELECT
    CASE topic WHEN 'raw.trades.v1' THEN 'trades' WHEN 'raw.depth.v1' THEN 'depth' ELSE 'dlq' END AS stream_kind,
    CASE WHEN topic = 'dlq.trades' THEN 'unknown' ELSE 'v' || CAST(user_id % 3 AS VARCHAR) END AS exchange,
    CASE WHEN topic = 'dlq.trades' THEN 'unknown'
         ELSE 'S' || CAST(event_id % 4 AS VARCHAR) || '-USD' END AS symbol,
    CASE WHEN topic <> 'dlq.trades' AND event_id % 53 <> 0 THEN ms END AS event_ts_ms,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_ts,
    topic AS kafka_topic,
    CAST(user_id % 6 AS INTEGER) AS kafka_partition,
    event_id * 2 + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS kafka_offset,
    ts AS kafka_ts,
    strftime(coalesce(CASE WHEN topic <> 'dlq.trades' AND event_id % 53 <> 0 THEN make_timestamp(ms * 1000) END, ts),
             '%Y-%m-%d') AS dt,
    CAST(event_id AS VARCHAR) AS p_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(value AS DECIMAL(20, 9)) END AS p_price,
    CAST(k AS DECIMAL(20, 9)) AS p_qty,
    CASE event_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS p_flag,
    CAST(value AS DECIMAL(20, 9)) AS p_bid,
    CAST(k AS DECIMAL(20, 9)) AS p_bid_qty,
    CASE WHEN k % 17 = 0 THEN NULL
         WHEN k % 19 = 0 THEN CAST(CAST(round(value * 100) AS BIGINT) AS DECIMAL(20, 0)) * CAST(0.01 AS DECIMAL(3, 2))
         ELSE CAST(CAST(round(value * 100) AS BIGINT) + k + 1 AS DECIMAL(20, 0)) * CAST(0.01 AS DECIMAL(3, 2))
    END AS p_ask,
    CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(k + 1 AS DECIMAL(20, 9)) END AS p_ask_qty
  FROM rec
)"""

LINEITEM_BRONZE = """
bronze_x AS (
  SELECT 'trades' AS stream_kind,
    'x' || CAST(l_suppkey % 4 AS VARCHAR) AS exchange,
    'P' || CAST(l_partkey % 16 AS VARCHAR) AS symbol,
    epoch_us(l_shipdate) // 1000 AS event_ts_ms,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_ts,
    'raw.trades.v1' AS kafka_topic,
    CAST(l_linenumber * 134217728 + l_partkey % 134217728 AS INTEGER) AS kafka_partition,
    l_orderkey * 8388608 + l_suppkey % 8388608 AS kafka_offset,
    l_shipdate AS kafka_ts,
    strftime(l_shipdate, '%Y-%m-%d') AS dt,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
      || '-' || CAST(l_suppkey AS VARCHAR) AS p_id,
    CAST(l_extendedprice AS DECIMAL(20, 9)) AS p_price,
    CAST(l_quantity AS DECIMAL(20, 9)) AS p_qty,
    l_returnflag = 'R' AS p_flag,
    CAST(NULL AS DECIMAL(20, 9)) AS p_bid, CAST(NULL AS DECIMAL(20, 9)) AS p_bid_qty,
    CAST(NULL AS DECIMAL(20, 9)) AS p_ask, CAST(NULL AS DECIMAL(20, 9)) AS p_ask_qty
  FROM lineitem
)"""

STAGING = """
bronze AS (
  SELECT stream_kind, exchange, symbol, event_ts_ms, ingest_ts, kafka_topic, kafka_partition,
         kafka_offset, kafka_ts, dt FROM bronze_x
),
t_parsed AS (
  SELECT *, coalesce(kafka_topic, '') || '|' || CAST(kafka_partition AS VARCHAR) || '|'
              || CAST(kafka_offset AS VARCHAR) AS trade_key,
         coalesce(make_timestamp(event_ts_ms * 1000), kafka_ts) AS event_ts,
         p_id AS trade_id, p_price AS price, p_qty AS quantity, p_flag AS is_buyer_maker
  FROM bronze_x WHERE stream_kind = 'trades'
),
t_valid AS (
  SELECT * FROM t_parsed
  WHERE trade_id IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL AND event_ts IS NOT NULL
    AND exchange IS NOT NULL AND symbol IS NOT NULL AND price > 0 AND quantity > 0
),
t_k1 AS (
  SELECT * FROM t_valid
  QUALIFY row_number() OVER (PARTITION BY trade_key ORDER BY ingest_ts DESC, event_ts DESC) = 1
),
stg_trades AS (
  SELECT trade_key, stream_kind, kafka_topic, kafka_partition, kafka_offset, kafka_ts, dt, exchange, symbol,
         trade_id, event_ts, price, quantity, is_buyer_maker, ingest_ts
  FROM t_k1
  QUALIFY row_number() OVER (PARTITION BY exchange, symbol, trade_id
                             ORDER BY kafka_offset DESC, kafka_partition DESC, kafka_topic DESC) = 1
),
d_parsed AS (
  SELECT *, coalesce(kafka_topic, '') || '|' || CAST(kafka_partition AS VARCHAR) || '|'
              || CAST(kafka_offset AS VARCHAR) AS depth_key,
         coalesce(make_timestamp(event_ts_ms * 1000), kafka_ts) AS event_ts,
         p_id AS update_id, p_bid AS best_bid_price, p_bid_qty AS best_bid_qty,
         p_ask AS best_ask_price, p_ask_qty AS best_ask_qty
  FROM bronze_x WHERE stream_kind = 'depth'
),
d_valid AS (
  SELECT *, (best_bid_price + best_ask_price) / 2 AS mid_price,
         best_ask_price - best_bid_price AS spread_abs
  FROM d_parsed
  WHERE best_bid_price IS NOT NULL AND best_ask_price IS NOT NULL AND best_bid_qty IS NOT NULL
    AND best_ask_qty IS NOT NULL AND event_ts IS NOT NULL AND exchange IS NOT NULL AND symbol IS NOT NULL
    AND best_bid_price > 0 AND best_ask_price > 0 AND best_ask_price > best_bid_price
),
stg_depth AS (
  SELECT depth_key, stream_kind, kafka_topic, kafka_partition, kafka_offset, kafka_ts, dt, exchange, symbol,
         update_id, event_ts, best_bid_price, best_bid_qty, best_ask_price, best_ask_qty, mid_price,
         spread_abs, 10000 * (CAST(spread_abs AS DOUBLE) / CAST(mid_price AS DOUBLE)) AS spread_bps, ingest_ts
  FROM d_valid
  QUALIFY row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset ORDER BY ingest_ts DESC) = 1
)"""


def _bars(bucket: str) -> str:
    return f"""
bars AS (
  SELECT exchange, symbol, date_trunc('{bucket}', event_ts) AS metric_ts,
         CAST(date_trunc('{bucket}', event_ts) AS DATE) AS metric_date,
         first(price ORDER BY event_ts, kafka_partition, kafka_offset) AS open_price,
         max(price) AS high_price, min(price) AS low_price,
         first(price ORDER BY event_ts DESC, kafka_partition DESC, kafka_offset DESC) AS close_price,
         sum(quantity) AS base_volume, count(*) AS trade_count,
         CAST(sum(price * quantity) AS DOUBLE) / CAST(nullif(sum(quantity), 0) AS DOUBLE) AS vwap
  FROM stg_trades GROUP BY 1, 2, 3, 4
),
candles_f AS (
  SELECT *, base_volume = 0 AS zero_volume_flag,
         coalesce(abs(CAST(close_price - m AS DOUBLE) / nullif(CAST(m AS DOUBLE), 0)) > 0.10, FALSE) AS price_spike_flag,
         m AS rolling_avg_close_5m
  FROM (SELECT *, avg(close_price) OVER five AS m FROM bars
        WINDOW five AS (PARTITION BY exchange, symbol ORDER BY metric_ts ROWS 4 PRECEDING))
),
depth_b AS (
  SELECT exchange, symbol, date_trunc('{bucket}', event_ts) AS metric_ts,
         CAST(date_trunc('{bucket}', event_ts) AS DATE) AS metric_date,
         avg(spread_bps) AS avg_spread_bps, avg(mid_price) AS avg_mid_price,
         quantile_disc(mid_price, 0.5) AS median_mid_price
  FROM stg_depth GROUP BY 1, 2, 3, 4
),
dlq_b AS (
  SELECT date_trunc('{bucket}', kafka_ts) AS metric_ts, CAST(date_trunc('{bucket}', kafka_ts) AS DATE) AS metric_date,
         count(*) AS dead_letter_count
  FROM bronze WHERE kafka_topic LIKE 'dlq.%' GROUP BY 1, 2
)"""


def _gold() -> str:
    return """
moves AS (
  SELECT exchange, symbol, metric_ts,
         CASE WHEN close_price > 0 AND lag(close_price) OVER series > 0
              THEN ln(CAST(close_price AS DOUBLE) / CAST(lag(close_price) OVER series AS DOUBLE)) END AS move
  FROM bars WINDOW series AS (PARTITION BY exchange, symbol ORDER BY metric_ts)
),
gold AS (
  SELECT exchange, symbol, metric_ts, c.metric_date, open_price AS open, high_price AS high, low_price AS low,
         close_price AS close, base_volume AS volume, vwap, d.avg_spread_bps AS spread_bps,
         stddev_samp(move) OVER (series ROWS 14 PRECEDING) AS volatility,
         stddev_samp(move) OVER (series ROWS 59 PRECEDING) AS volatility_60m,
         (SELECT coalesce(sum(q.dead_letter_count), 0)::BIGINT FROM dlq_b q WHERE q.metric_ts = c.metric_ts) AS dead_letter_count,
         zero_volume_flag, price_spike_flag, zero_volume_flag OR price_spike_flag AS anomaly_flag, trade_count,
         d.avg_mid_price, d.median_mid_price
  FROM candles_f c JOIN moves USING (exchange, symbol, metric_ts)
       LEFT JOIN depth_b d USING (exchange, symbol, metric_ts)
  WINDOW series AS (PARTITION BY exchange, symbol ORDER BY metric_ts)
)"""


def with_events(*blocks: str) -> str:
    return "WITH " + ",".join((EVENTS_BRONZE, STAGING) + blocks)


def with_lineitem(*blocks: str) -> str:
    return "WITH " + ",".join((LINEITEM_BRONZE, STAGING) + blocks)


def as_double(sql: str, cols) -> str:
    """Present exact decimals as DOUBLE, as the Spark side does."""
    rep = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _d"


TRADE_DEC = ("price", "quantity")
DEPTH_DEC = ("best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty", "spread_abs", "mid_price")
CANDLE_DEC = ("open_price", "high_price", "low_price", "close_price", "base_volume")
GOLD_DEC = ("open", "high", "low", "close", "volume", "median_mid_price")


def r6(c: str, alias: str | None = None) -> str:
    return f"round(CAST({c} AS DOUBLE), 6) AS {alias or c}"


CANDLE_SELECT = ("exchange, symbol, metric_ts, metric_date, open_price, high_price, low_price, close_price, "
                 "base_volume, trade_count, vwap, " + r6("rolling_avg_close_5m")
                 + ", zero_volume_flag, price_spike_flag, zero_volume_flag OR price_spike_flag AS anomaly_flag")

GOLD_SELECT = ("exchange, symbol, metric_ts, metric_date, open, high, low, close, volume, vwap, "
               + r6("spread_bps") + ", " + r6("volatility") + ", " + r6("volatility_60m")
               + ", dead_letter_count, zero_volume_flag, price_spike_flag, anomaly_flag, trade_count, "
               + r6("avg_mid_price") + ", median_mid_price")

MARKET_SQL = {
    "b7_bronze_events": with_events() + """
SELECT stream_kind, exchange, symbol, event_ts_ms, ingest_ts, kafka_topic, kafka_partition, kafka_offset,
       kafka_ts, dt FROM bronze""",
    "t9_stg_trades": with_events() + "\nSELECT * FROM stg_trades",
    "t14_stg_depth": with_events() + "\nSELECT depth_key, stream_kind, kafka_topic, kafka_partition, kafka_offset, "
    "kafka_ts, dt, exchange, symbol, update_id, event_ts, best_bid_price, best_bid_qty, best_ask_price, "
    "best_ask_qty, mid_price, spread_abs, spread_bps, ingest_ts FROM stg_depth",
    "a1_candles_day": with_events(_bars("day")) + f"\nSELECT {CANDLE_SELECT} FROM candles_f",
    "a1_candles_hour": with_events(_bars("hour")) + f"\nSELECT {CANDLE_SELECT} FROM candles_f",
    "a1_candles_lineitem_day": with_lineitem(_bars("day")) + f"\nSELECT {CANDLE_SELECT} FROM candles_f",
    "a4_depth_hour": with_events(_bars("hour")) + "\nSELECT exchange, symbol, metric_ts, metric_date, "
    + r6("avg_spread_bps") + ", " + r6("avg_mid_price") + ", median_mid_price FROM depth_b",
    "a6_dlq_hour": with_events(_bars("hour")) + "\nSELECT * FROM dlq_b",
    "g4_gold_hour": with_events(_bars("hour"), _gold()) + f"\nSELECT {GOLD_SELECT} FROM gold",
    "g4_gold_lineitem_day": with_lineitem(_bars("day"), _gold()) + f"\nSELECT {GOLD_SELECT} FROM gold",
}

MARKET_SQL["q61_required_json_fields"] = with_events() + """
SELECT kafka_topic, kafka_partition, kafka_offset, exchange, symbol FROM bronze_x
WHERE stream_kind = 'trades' AND event_ts_ms IS NULL"""
MARKET_SQL["q63_unique_grain_candles"] = with_events(_bars("hour")) + """
SELECT exchange, symbol, metric_ts, count(*) AS n_records FROM candles_f GROUP BY 1, 2, 3 HAVING count(*) > 1"""
MARKET_SQL["q65_source_freshness"] = with_events() + """
SELECT max(kafka_ts) AS max_loaded_at,
       CAST(epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(date_trunc('second', max(kafka_ts))) AS BIGINT) AS lag_seconds,
       CASE WHEN epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(date_trunc('second', max(kafka_ts))) > 300
            THEN 'error' ELSE 'pass' END AS status
FROM bronze"""
MARKET_SQL["q66_suite_fused"] = """
SELECT check_name, model, failures, severity,
       CASE WHEN severity = 'error' AND (CASE WHEN check_name = 'li_flag_not_r' THEN failures > 20000
                                              ELSE failures <> 0 END) THEN 'error'
            WHEN failures <> 0 THEN 'warn' ELSE 'pass' END AS status
FROM (VALUES
  ('li_discount_le_008', 'lineitem', (SELECT count(*) FROM lineitem WHERE l_discount > 0.08), 'error'),
  ('li_qty_2_49', 'lineitem', (SELECT count(*) FROM lineitem WHERE NOT (l_quantity >= 2 AND l_quantity <= 49)), 'warn'),
  ('li_flag_not_r', 'lineitem', (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R'), 'error'),
  ('o_priority_in_set', 'orders',
   (SELECT count(*) FROM orders WHERE NOT coalesce(o_orderpriority IN ('1-URGENT', '2-HIGH'), false)), 'error'),
  ('o_custkey_unique', 'orders', (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL
                                   GROUP BY 1 HAVING count(*) > 1)), 'error'),
  ('li_order_line_unique', 'lineitem', (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem
                                   GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 'error')
) v(check_name, model, failures, severity)
"""

def _project_suite_sql() -> str:
    from marketlake.plans.suite import project_suite_sql
    candles_o = """,
candles_o AS (SELECT *, zero_volume_flag OR price_spike_flag AS anomaly_flag FROM candles_f)"""
    return with_events(_bars("hour"), _gold()) + candles_o + "\n" + project_suite_sql()


MARKET_SQL["q67_project_suite"] = _project_suite_sql()

for _k, _cols in (("t9_stg_trades", TRADE_DEC), ("t14_stg_depth", DEPTH_DEC), ("a1_candles_day", CANDLE_DEC),
                  ("a1_candles_hour", CANDLE_DEC), ("a1_candles_lineitem_day", CANDLE_DEC),
                  ("a4_depth_hour", ("median_mid_price",)), ("g4_gold_hour", GOLD_DEC),
                  ("g4_gold_lineitem_day", GOLD_DEC)):
    MARKET_SQL[_k] = as_double(MARKET_SQL[_k], _cols)

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(MARKET_SQL)
