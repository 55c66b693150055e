"""Streaming and sink queries (Z1-Z7, K1, K8, K10) on the events feed.

Each query drains a real stream with ``availableNow`` (file source standing
in for the broker) into a fresh folder under the session's checkpoint root
and returns what the sink wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.calendar.spine import date_spine
from marketlake.operators.bronze import drop_required_nulls
from marketlake.operators.candles import candle_bars, depth_bars, dlq_bars
from marketlake.operators.staging import stg_depth, stg_trades
from marketlake.plans.gold import market_metrics, read_gold, write_gold
from marketlake.plans.oracle import CANDLE_DEC, GOLD_DEC, ORACLE_SQL, TRADE_DEC, _bars, _gold, as_double, with_events
from marketlake.plans.pipeline import events_bronze
from marketlake.plans.present import present
from marketlake.plans.quality_catalog import reg
from marketlake.session import ensure_conf, scratch_path, stored_table
from marketlake.sources.adapters import events_as_kafka
from marketlake.sources.bronze import (
    publish_days, read_bronze, read_bronze_published, stale_days, write_bronze_batch,
)
from marketlake.sources.silver import read_silver, write_silver
from marketlake.streaming import jobs as Z

WATERMARK = "1 hour"


def _ingested_bronze(spark, sf):
    """Events -> Kafka-shaped log files -> streaming bronze ingest."""
    ensure_conf(spark)
    base = scratch_path(spark, "z1")
    events_as_kafka(spark, sf).write.parquet(f"{base}/log")
    q = Z.start_bronze_ingest(Z.read_records_stream(spark, f"{base}/log"), f"{base}/bronze", f"{base}/_ckpt",
                              available_now=True)
    q.awaitTermination()
    return base, read_bronze(spark, f"{base}/bronze")


@reg("z1_stream_bronze_ingest", ORACLE_SQL["b7_bronze_events"])
def _z1(s, sf):
    _, b = _ingested_bronze(s, sf)
    return b.drop("payload").select("stream_kind", "exchange", "symbol", "event_ts_ms", "ingest_ts", "kafka_topic",
                                    "kafka_partition", "kafka_offset", "kafka_ts", "dt")


_BAR_COLUMNS = ("exchange, symbol, metric_ts, metric_date, open_price, high_price, low_price, close_price, base_volume, "
                "trade_count, vwap")


@reg("z4_stream_candles_day", as_double(with_events(_bars("day")) + f"\nSELECT {_BAR_COLUMNS} FROM bars", CANDLE_DEC))
def _z4(s, sf):
    base, _ = _ingested_bronze(s, sf)
    out = Z.stream_candles_available_now(s, f"{base}/bronze", f"{base}/z4", bucket="day", watermark=WATERMARK)
    return Z.with_open_windows(s, s.read.parquet(out), f"{base}/bronze",
                               lambda b: candle_bars(stg_trades(b), "day"), f"{base}/z4/_ckpt", "day")


@reg("z5_stream_dlq_hour", with_events(_bars("hour")) + "\nSELECT * FROM dlq_b")
def _z5(s, sf):
    base, _ = _ingested_bronze(s, sf)
    b = Z.read_bronze_stream(s, f"{base}/bronze")
    Z.run_available_now(Z.stream_dlq_bars(b, "hour", WATERMARK), f"{base}/z5", f"{base}/_ckpt5")
    return Z.with_open_windows(s, s.read.parquet(f"{base}/z5"), f"{base}/bronze",
                               lambda b: dlq_bars(b, "hour"), f"{base}/_ckpt5", "hour")


@reg("z5_stream_depth_day", with_events(_bars("day")) + """
SELECT exchange, symbol, metric_ts, metric_date, round(CAST(avg_spread_bps AS DOUBLE), 6) AS avg_spread_bps,
       round(CAST(avg_mid_price AS DOUBLE), 6) AS avg_mid_price, CAST(median_mid_price AS DOUBLE) AS median_mid_price
FROM depth_b""")
def _z5d(s, sf):
    base, _ = _ingested_bronze(s, sf)
    b = Z.read_bronze_stream(s, f"{base}/bronze")
    Z.run_available_now(Z.stream_depth_bars(b, "day", WATERMARK), f"{base}/z5d", f"{base}/_ckpt5d")
    bars = Z.with_open_windows(s, s.read.parquet(f"{base}/z5d"), f"{base}/bronze",
                               lambda b: depth_bars(stg_depth(b), "day"), f"{base}/_ckpt5d", "day")
    return present(bars, round6=("avg_spread_bps", "avg_mid_price"))


@reg("z3_stream_trades_dedup", as_double(with_events() + """
SELECT exchange, symbol, trade_id, event_ts, price, quantity, is_buyer_maker FROM stg_trades""", TRADE_DEC))
def _z3(s, sf):
    base, _ = _ingested_bronze(s, sf)
    t = Z.stream_trades(Z.read_bronze_stream(s, f"{base}/bronze"), WATERMARK) \
        .select("exchange", "symbol", "trade_id", "event_ts", "price", "quantity", "is_buyer_maker")
    Z.run_available_now(t, f"{base}/z3", f"{base}/_ckpt3")
    return s.read.parquet(f"{base}/z3")


@reg("k1_bronze_partition_pruned_counts", with_events() + """
SELECT dt, symbol, exchange, count(*) AS row_count FROM bronze WHERE dt BETWEEN '2024-01-05' AND '2024-01-07'
GROUP BY 1, 2, 3""")
def _k1(s, sf):
    base = scratch_path(s, "k1")
    write_bronze_batch(events_bronze(s, sf), f"{base}/bronze")
    b = read_bronze(s, f"{base}/bronze", dt_from="2024-01-05", dt_to="2024-01-07")
    return b.groupBy("dt", "symbol", "exchange").agg(F.count(F.lit(1)).alias("row_count"))


GOLD_DAY_SELECT = ("exchange, symbol, metric_ts, metric_date, open, high, low, close, volume, vwap, "
                   "round(CAST(spread_bps AS DOUBLE), 6) AS spread_bps, round(volatility, 6) AS volatility, "
                   "round(volatility_60m, 6) AS volatility_60m, dead_letter_count, zero_volume_flag, "
                   "price_spike_flag, anomaly_flag, trade_count, round(CAST(avg_mid_price AS DOUBLE), 6) AS "
                   "avg_mid_price, median_mid_price")


def _late(col="event_ts"):
    """A late batch in the middle of the range: part of the trades of three days."""
    ts = F.col(col)
    inside = (ts >= F.lit("2024-01-10").cast("timestamp")) & (ts < F.lit("2024-01-13").cast("timestamp"))
    return inside & (F.pmod(F.xxhash64("trade_id"), F.lit(3)) == 0)


def _gold_before_late(s, sf, name, bucket):
    """Bronze, silver and gold without the late trades; paths and the late trades."""
    base = scratch_path(s, name)
    paths = {k: f"{base}/{k}" for k in ("trades", "depth", "bronze", "gold")}
    write_bronze_batch(events_bronze(s, sf), paths["bronze"])
    b = read_bronze(s, paths["bronze"])
    t = stored_table(stg_trades(b), "staged")
    write_silver(t.filter(~_late()), paths["trades"])
    write_silver(stg_depth(b), paths["depth"])
    write_gold(market_metrics(read_silver(s, paths["trades"]), read_silver(s, paths["depth"]), b, bucket,
                              exact_median=True), paths["gold"])
    return paths, t.filter(_late())


def _present_gold(s, path):
    return present(read_gold(s, path), round6=("spread_bps", "volatility", "volatility_60m", "avg_mid_price"))


def _refreshed(s, sf, name, bucket, times=1):
    """The late batch applied with default arguments must equal a full rebuild, also when it is applied again."""
    p, late = _gold_before_late(s, sf, name, bucket)
    for _ in range(times):
        write_silver(late, p["trades"])
        Z.refresh_gold_for_batch(s, p["trades"], p["depth"], p["bronze"], p["gold"], late, bucket, exact_median=True)
    return _present_gold(s, p["gold"])


@reg("z6_incremental_gold_day", as_double(with_events(_bars("day"), _gold()) + f"\nSELECT {GOLD_DAY_SELECT} FROM gold",
                                          GOLD_DEC))
def _z6(s, sf):
    return _refreshed(s, sf, "z6", "day")


@reg("z6_incremental_gold_minute", as_double(with_events(_bars("minute"), _gold())
                                             + f"\nSELECT {GOLD_DAY_SELECT} FROM gold", GOLD_DEC))
def _z6m(s, sf):
    return _refreshed(s, sf, "z6m", "minute")


@reg("z6_replayed_batch_hour", as_double(with_events(_bars("hour"), _gold())
                                         + f"\nSELECT {GOLD_DAY_SELECT} FROM gold", GOLD_DEC))
def _z6r(s, sf):
    return _refreshed(s, sf, "z6r", "hour", times=2)


@reg("z7_repaired_late_rows_hour", as_double(with_events(_bars("hour"), _gold())
                                             + f"\nSELECT {GOLD_DAY_SELECT} FROM gold", GOLD_DEC))
def _z7(s, sf):
    """The late trades never reached silver; the repair job finds them in bronze."""
    p, _ = _gold_before_late(s, sf, "z7", "hour")
    Z.repair_days(s, p["trades"], p["depth"], p["bronze"], p["gold"], "2024-01-10", "2024-01-12", "hour", True)
    return _present_gold(s, p["gold"])


@reg("k2_published_bronze", ORACLE_SQL["b7_bronze_events"])
def _k2(s, sf):
    """Stream half of the records, publish two days, stream the rest (late
    rows for these days too), publish a third day and the stale ones: every
    row once.  The second run of the stream resumes from its checkpoint."""
    base = scratch_path(s, "k2")
    log, landing, table = f"{base}/log", f"{base}/landing", f"{base}/table"
    records = stored_table(events_as_kafka(s, sf), "records")
    half = F.pmod(F.col("offset"), F.lit(4)) < 2
    for k, part in enumerate((records.filter(half), records.filter(~half))):
        part.write.mode("append").parquet(log)
        Z.start_bronze_ingest(Z.read_records_stream(s, log), landing, f"{base}/_ckpt", available_now=True).awaitTermination()
        publish_days(s, landing, table, *(("2024-01-05", "2024-01-06") if k == 0 else ("2024-01-08", "2024-01-08")))
    stale = stale_days(s, landing, table).agg(F.min("dt"), F.max("dt")).first()
    if stale[0]:
        publish_days(s, landing, table, *stale)
    b = read_bronze_published(s, landing, table)
    return b.select("stream_kind", "exchange", "symbol", "event_ts_ms", "ingest_ts", "kafka_topic",
                    "kafka_partition", "kafka_offset", "kafka_ts", "dt")


@reg("k5_required_columns", with_events() + """
SELECT stream_kind, count(*) AS row_count FROM bronze WHERE event_ts_ms IS NOT NULL AND symbol IS NOT NULL GROUP BY 1""")
def _k5(s, sf):
    b = drop_required_nulls(events_bronze(s, sf), ["event_ts_ms", "symbol"])
    return b.groupBy("stream_kind").agg(F.count(F.lit(1)).alias("row_count"))


@reg("j11_missing_hours_by_series", with_events(_bars("hour")) + """,
ends AS (SELECT exchange, symbol, min(metric_ts) AS lo, max(metric_ts) AS hi FROM bars GROUP BY 1, 2),
hours AS (SELECT exchange, symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS date_hour FROM ends)
SELECT h.exchange, h.symbol, h.date_hour FROM hours h
WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.exchange = h.exchange AND b.symbol = h.symbol AND b.metric_ts = h.date_hour)""")
def _j11(s, sf):
    """Hours without a trade, per series, between its first and last trade."""
    bars = candle_bars(stg_trades(events_bronze(s, sf)), "hour")
    ends = bars.groupBy("exchange", "symbol").agg(F.min("metric_ts").alias("start_date"), F.max("metric_ts").alias("end_date"))
    spine = date_spine(ends, "hour").withColumnRenamed("date_hour", "metric_ts")
    missing = spine.join(bars, ["exchange", "symbol", "metric_ts"], "left_anti")
    return present(missing.withColumnRenamed("metric_ts", "date_hour"))
