"""Serving queries (V1-V14) registered on the events-fed gold mart (minute grain)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.plans import serving as V
from marketlake.plans.oracle import ORACLE_SQL, _bars, _gold, as_double, with_events
from marketlake.plans.pipeline import events_bronze
from marketlake.plans.quality_catalog import reg
from marketlake.plans.tables import events_gold, stored_bronze
from marketlake.sources.adapters import events_as_kafka

NOW = "2024-01-31 00:00:00"
NOW_5M = "2024-01-15 12:03:00"
SERIES = ("v0", "S0-USD")


G = with_events(_bars("minute"), _gold())


def _gsql(body: str) -> str:
    return G + "\n" + body


@reg("v1_candlestick", _gsql(
    f"SELECT metric_ts AS time, CAST(open AS DOUBLE) AS open, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, "
    f"CAST(close AS DOUBLE) AS close FROM gold WHERE exchange = '{SERIES[0]}' AND symbol = '{SERIES[1]}' "
    f"AND metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"))
def _v1(s, sf):
    return V.candlestick(events_gold(s, sf), SERIES[0], SERIES[1], NOW)


@reg("v2_volume_by_series", _gsql(
    f"SELECT metric_ts AS time, exchange || ':' || symbol AS metric, CAST(volume AS DOUBLE) AS volume FROM gold "
    f"WHERE metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"))
def _v2(s, sf):
    return V.volume_by_series(events_gold(s, sf), NOW)


@reg("v3_spread_series", with_events(_bars("hour"), _gold()) + "\n" + (
    f"SELECT metric_ts AS time, exchange || ':' || symbol AS metric, round(CAST(spread_bps AS DOUBLE), 6) AS "
    f"spread_bps FROM gold WHERE spread_bps IS NOT NULL AND metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"),
     round6=())
def _v3(s, sf):
    from pyspark.sql import functions as F
    return V.spread_series(events_gold(s, sf, "hour"), NOW).withColumn("spread_bps", F.round("spread_bps", 6))


@reg("v4_vwap_vs_mid", _gsql(
    f"SELECT metric_ts AS time, 'vwap' AS metric, CAST(vwap AS DOUBLE) AS value FROM gold WHERE exchange = "
    f"'{SERIES[0]}' AND symbol = '{SERIES[1]}' AND metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY UNION ALL "
    f"SELECT metric_ts, 'mid_price', CAST(avg_mid_price AS DOUBLE) FROM gold WHERE exchange = '{SERIES[0]}' "
    f"AND symbol = '{SERIES[1]}' AND metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"))
def _v4(s, sf):
    return V.vwap_vs_mid(events_gold(s, sf), SERIES[0], SERIES[1], NOW)


@reg("v5_volatility_heatmap", _gsql(
    f"SELECT exchange || ':' || symbol AS symbol, CAST(hour(metric_ts) AS INTEGER) AS hour_of_day, "
    f"avg(volatility) AS volatility FROM gold WHERE volatility IS NOT NULL AND metric_ts >= TIMESTAMP '{NOW}' "
    f"- INTERVAL 3 DAY GROUP BY 1, 2"), round6=("volatility",))
def _v5(s, sf):
    return V.volatility_heatmap(events_gold(s, sf), NOW)


@reg("v6_dlq_recent", _gsql(
    f"SELECT max(metric_ts) AS time, CAST(coalesce(sum(dead_letter_count), 0) AS DOUBLE) AS dlq_5m FROM gold "
    f"WHERE metric_ts >= TIMESTAMP '{NOW_5M}' - INTERVAL 5 MINUTE"))
def _v6(s, sf):
    return V.dlq_recent(events_gold(s, sf), NOW_5M)


@reg("v7_freshness_lag", _gsql(
    f"SELECT TIMESTAMP '{NOW}' AS time, CAST(date_diff('second', max(metric_ts), TIMESTAMP '{NOW}') AS DOUBLE) "
    f"AS freshness_lag_seconds FROM gold"))
def _v7(s, sf):
    return V.freshness_lag(events_gold(s, sf), NOW)


@reg("v8_rows_recent", _gsql(
    f"SELECT TIMESTAMP '{NOW}' AS time, CAST(count(*) AS DOUBLE) AS rows_2d FROM gold "
    f"WHERE metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY"))
def _v8(s, sf):
    return V.rows_recent(events_gold(s, sf), NOW)


@reg("v9_latest_rows", as_double(_gsql(
    "SELECT metric_ts, exchange, symbol, close, volume, spread_bps, volatility, dead_letter_count FROM gold "
    "ORDER BY metric_ts DESC, exchange, symbol LIMIT 100"), ("close", "volume")), round6=("spread_bps", "volatility"))
def _v9(s, sf):
    return V.latest_rows(events_gold(s, sf), 100)


@reg("v9_health_rows", as_double(_gsql(
    "SELECT metric_ts, exchange, symbol, dead_letter_count, anomaly_flag, volume, spread_bps, volatility FROM gold "
    "ORDER BY metric_ts DESC, exchange, symbol LIMIT 200"), ("volume",)), round6=("spread_bps", "volatility"))
def _v9h(s, sf):
    return V.health_rows(events_gold(s, sf), 200)


@reg("v10_rows_per_series", _gsql(
    f"SELECT exchange, symbol, count(*) AS rows_2d, max(metric_ts) AS latest_ts FROM gold "
    f"WHERE metric_ts >= TIMESTAMP '{NOW}' - INTERVAL 2 DAY GROUP BY 1, 2"))
def _v10(s, sf):
    return V.rows_per_series(events_gold(s, sf), NOW)


@reg("v11_latest_epoch", _gsql("SELECT CAST(epoch(max(metric_ts)) AS DOUBLE) AS latest_metric_ts_epoch FROM gold"))
def _v11(s, sf):
    return V.latest_epoch(events_gold(s, sf))


@reg("v11_total_rows", _gsql("SELECT CAST(count(*) AS DOUBLE) AS total_rows FROM gold"))
def _v11b(s, sf):
    return V.total_rows(events_gold(s, sf))


_ALERT = (f"SELECT TIMESTAMP '{NOW_5M}' AS time, value, value > 25 AS firing FROM (SELECT CAST(coalesce(sum("
          "dead_letter_count), 0) AS DOUBLE) AS value FROM {src})")


@reg("v12_dlq_alert", _gsql(_ALERT.format(
    src=f"gold WHERE metric_ts >= TIMESTAMP '{NOW_5M}' - INTERVAL 5 MINUTE")))
def _v12(s, sf):
    return V.dlq_alert(events_gold(s, sf), NOW_5M)


@reg("v12_dlq_alert_per_minute", _gsql(_ALERT.format(
    src=f"(SELECT metric_ts, max(dead_letter_count) AS dead_letter_count FROM gold WHERE metric_ts >= "
        f"TIMESTAMP '{NOW_5M}' - INTERVAL 5 MINUTE GROUP BY 1)")))
def _v12m(s, sf):
    return V.dlq_alert(events_gold(s, sf), NOW_5M, per_minute=True)


@reg("v13_bronze_day_counts", with_events() + "\nSELECT dt, count(*) AS row_count FROM bronze "
     "WHERE dt >= '2024-01-10' AND dt <= '2024-01-12' GROUP BY dt")
def _v13(s, sf):
    return V.bronze_day_counts(stored_bronze(s, sf), "2024-01-10", "2024-01-12")


@reg("v14_reconcile_offsets", with_events() + """
SELECT kafka_topic, kafka_partition, min(kafka_offset) AS min_offset, max(kafka_offset) AS max_offset,
       count(DISTINCT kafka_offset) AS distinct_offsets, count(*) AS row_count,
       max(kafka_offset) - min(kafka_offset) + 1 AS expected_offsets,
       max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS gaps,
       count(*) - count(DISTINCT kafka_offset) AS duplicates
FROM bronze GROUP BY 1, 2""")
def _v14(s, sf):
    return V.reconcile_offsets(events_bronze(s, sf))


@reg("v14_offset_delta", with_events() + """,
log AS (SELECT topic, CAST(user_id % 6 AS INTEGER) AS p, max(event_id) * 2 + 2 AS end_offset FROM ev
        WHERE topic IS NOT NULL GROUP BY 1, 2)
SELECT l.topic AS kafka_topic, l.p AS kafka_partition, l.end_offset, count(b.kafka_offset) AS row_count,
       l.end_offset - count(b.kafka_offset) AS delta
FROM log l LEFT JOIN bronze b ON b.kafka_topic = l.topic AND b.kafka_partition = l.p AND b.dt <> '2024-01-05'
GROUP BY 1, 2, 3""")
def _v14d(s, sf):
    """Bronze without one day against the end of the log: the delta counts what is missing, too."""
    log = events_as_kafka(s, sf).groupBy("topic", "partition").agg(
        (F.floor(F.max("offset") / 2) * 2 + 2).alias("end_offset"))
    r = V.reconcile_offsets(events_bronze(s, sf).filter("dt <> '2024-01-05'"), log)
    return r.select("kafka_topic", "kafka_partition", "end_offset", F.coalesce("row_count", F.lit(0)).alias("row_count"), "delta")


__all__ = ["ORACLE_SQL"]
