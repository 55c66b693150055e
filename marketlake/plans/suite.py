"""The project's declared tests (Q67) as data for the suite runner (Q66)."""

from __future__ import annotations

from marketlake.quality.project import CheckSpec

NOT_NULL = {
    "stg_trades": ["trade_key", "exchange", "symbol", "trade_id", "event_ts", "price", "quantity"],
    "stg_depth": ["depth_key", "exchange", "symbol", "event_ts", "best_bid_price", "best_ask_price", "mid_price"],
    "int_ohlcv_1m": ["metric_ts", "metric_date", "exchange", "symbol", "open_price", "high_price", "low_price",
                     "close_price", "base_volume", "zero_volume_flag", "price_spike_flag", "anomaly_flag", "vwap"],
    "int_depth_1m": ["metric_ts", "metric_date", "exchange", "symbol", "avg_spread_bps", "avg_mid_price",
                     "median_mid_price"],
    "int_dlq_1m": ["metric_ts", "metric_date", "dead_letter_count"],
    "fct_market_metrics": ["exchange", "symbol", "metric_ts", "metric_date", "open", "high", "low", "close",
                           "volume", "vwap", "dead_letter_count", "zero_volume_flag", "price_spike_flag",
                           "anomaly_flag"],
}
UNIQUE = {"stg_trades": ["trade_key"], "stg_depth": ["depth_key"], "int_dlq_1m": ["metric_ts"]}
GRAIN = ["int_ohlcv_1m", "int_depth_1m", "fct_market_metrics"]
REQUIRED_JSON = [
    ("trades", ["trade_id", "event_ts_ms", "price", "quantity", "ingest_ts"]),
    ("depth", ["update_id", "event_ts_ms", "bids", "asks", "ingest_ts"]),
]


def project_suite() -> list[CheckSpec]:
    specs: list[CheckSpec] = []
    for model, cols in NOT_NULL.items():
        specs += [CheckSpec(f"not_null_{model}_{c}", model, "values_to_not_be_null", {"column": c}) for c in cols]
    for model, cols in UNIQUE.items():
        specs += [CheckSpec(f"unique_{model}_{c}", model, "values_to_be_unique", {"column": c}) for c in cols]
    specs.append(CheckSpec("unique_combination_stg_trades_trade_id_event_ts", "stg_trades",
                           "unique_column_combination", {"columns": ["trade_id", "event_ts"]}))
    specs.append(CheckSpec("between_int_ohlcv_1m_base_volume", "int_ohlcv_1m", "values_to_be_between",
                           {"column": "base_volume", "min_value": 0, "strictly": False}))
    specs += [CheckSpec(f"unique_grain_{m}", m, "unique_grain") for m in GRAIN]
    specs += [CheckSpec(f"required_json_fields_bronze_{kind}", "bronze", "required_json_fields",
                        {"json_column": "payload", "required_fields": fields,
                         "row_filter": f"stream_kind = '{kind}'"}) for kind, fields in REQUIRED_JSON]
    return specs


# DuckDB tables of the oracle pipeline (plans/oracle.py CTEs) per model.
ORACLE_TABLES = {"stg_trades": "stg_trades", "stg_depth": "stg_depth", "int_ohlcv_1m": "candles_o",
                 "int_depth_1m": "depth_b", "int_dlq_1m": "dlq_b", "fct_market_metrics": "gold"}


def project_suite_sql() -> str:
    """Oracle SQL for ``project_suite()`` on the events feed (hourly grain):
    one count per declared check, in the suite runner's output shape."""
    parts = []
    for model, cols in NOT_NULL.items():
        t = ORACLE_TABLES[model]
        parts += [f"SELECT 'not_null_{model}_{c}' AS check_name, '{model}' AS model, count(*) AS failures "
                  f"FROM {t} WHERE {c} IS NULL" for c in cols]
    for model, cols in UNIQUE.items():
        t = ORACLE_TABLES[model]
        parts += [f"SELECT 'unique_{model}_{c}', '{model}', count(*) FROM (SELECT {c} FROM {t} "
                  f"WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" for c in cols]
    parts.append("SELECT 'unique_combination_stg_trades_trade_id_event_ts', 'stg_trades', count(*) FROM "
                 "(SELECT trade_id, event_ts FROM stg_trades GROUP BY 1, 2 HAVING count(*) > 1)")
    parts.append("SELECT 'between_int_ohlcv_1m_base_volume', 'int_ohlcv_1m', count(*) FROM candles_o "
                 "WHERE NOT (base_volume >= 0)")
    parts += [f"SELECT 'unique_grain_{m}', '{m}', count(*) FROM (SELECT exchange, symbol, metric_ts FROM "
              f"{ORACLE_TABLES[m]} GROUP BY 1, 2, 3 HAVING count(*) > 1)" for m in GRAIN]
    # the oracle's bronze has no payload text: a required field is missing only
    # where the feed plants it (event_ts_ms)
    parts += [f"SELECT 'required_json_fields_bronze_{kind}', 'bronze', count(*) FROM bronze "
              f"WHERE stream_kind = '{kind}' AND event_ts_ms IS NULL" for kind, _ in REQUIRED_JSON]
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT check_name, model, CAST(failures AS BIGINT) AS failures, 'error' AS severity, "
            f"CASE WHEN failures <> 0 THEN 'error' ELSE 'pass' END AS status FROM (\n{body}\n)")
