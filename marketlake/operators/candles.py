"""Minute (or hour/day) roll-ups and the rolling columns on top.

Candles are computed with a plain ``groupBy`` so Spark runs a partial
aggregate in every map task: a symbol holding a third of all ticks is reduced
to one row per minute *before* the shuffle, and the exchange moves only
partial candles.  Rolling windows then run on minute rows, whose count per
series is bounded by the length of the time range, not by tick volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions import notional, safe_divide
from marketlake.schemas import (
    CANDLE_COLUMNS, DEPTH_1M_COLUMNS, DLQ_1M_COLUMNS, DLQ_TOPIC_LIKE, PRICE_SPIKE_THRESHOLD,
    ROLLING_CLOSE_ROWS, SERIES_KEYS,
)

BUCKETS = ("second", "minute", "hour", "day", "week", "month")


def _bucket(ts: str, bucket: str) -> Column:
    if bucket not in BUCKETS:
        raise ValueError(f"bucket must be one of {BUCKETS}")
    return F.date_trunc(bucket, F.col(ts))


def tick_order() -> Column:
    """Total order of ticks inside a bucket: time, then Kafka position.

    Event time has millisecond resolution, so ties are common; breaking them
    by (partition, offset) makes open/close deterministic.
    """
    return F.struct("event_ts", "kafka_partition", "kafka_offset")


def candle_bars(trades: DataFrame, bucket: str = "minute") -> DataFrame:
    """A1-A3: OHLCV + trade count + VWAP per (exchange, symbol, bucket).

    Sums stay exact decimals; VWAP divides in DOUBLE and is NULL when the
    volume is zero.
    """
    pq = notional()
    bars = (trades
            .groupBy(*SERIES_KEYS, _bucket("event_ts", bucket).alias("metric_ts"))
            .agg(F.min_by("price", tick_order()).alias("open_price"),
                 F.max("price").alias("high_price"),
                 F.min("price").alias("low_price"),
                 F.max_by("price", tick_order()).alias("close_price"),
                 F.sum("quantity").alias("base_volume"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.sum(pq).alias("_notional")))
    return bars.select(
        *SERIES_KEYS, "metric_ts", F.to_date("metric_ts").alias("metric_date"),
        "open_price", "high_price", "low_price", "close_price", "base_volume", "trade_count",
        safe_divide(F.col("_notional").cast("double"),
                    F.nullif(F.col("base_volume"), F.lit(0)).cast("double")).alias("vwap"))


def series_window(rows: tuple[int, int] | None = None) -> Window:
    w = Window.partitionBy(*SERIES_KEYS).orderBy("metric_ts")
    return w.rowsBetween(*rows) if rows else w


def rollup_columns() -> list[Column]:
    """W1 + G1-G3 as column expressions over the series window.

    The frame is ROWS (the last 5 *traded* buckets), not a time range.
    """
    avg5 = F.avg("close_price").over(series_window((-(ROLLING_CLOSE_ROWS - 1), 0)))
    return [avg5.alias("rolling_avg_close_5m")]


def flag_columns() -> list[Column]:
    zero = F.col("base_volume") == 0
    dev = safe_divide((F.col("close_price") - F.col("rolling_avg_close_5m")).cast("double"),
                      F.col("rolling_avg_close_5m").cast("double"))
    spike = F.coalesce(F.abs(dev) > PRICE_SPIKE_THRESHOLD, F.lit(False))
    return [zero.alias("zero_volume_flag"), spike.alias("price_spike_flag"),
            (zero | spike).alias("anomaly_flag")]


def candles(trades: DataFrame, bucket: str = "minute") -> DataFrame:
    """int_ohlcv_1m: bars plus the 5-row rolling close and anomaly flags."""
    bars = candle_bars(trades, bucket)
    return bars.select("*", *rollup_columns()).select("*", *flag_columns()).select(*CANDLE_COLUMNS)


def fill_gaps(bars: DataFrame, bucket: str = "minute") -> DataFrame:
    """Optional: one row per bucket between a series' first and last bar.

    Missing buckets get zero volume and NULL prices, which is the only way
    ``zero_volume_flag`` can become true.  The spine is generated per series
    from its own (min, max) -- a per-row ``sequence`` -- so no cross join
    and no single-partition step.
    """
    step = F.expr(f"interval 1 {bucket}")
    spans = bars.groupBy(*SERIES_KEYS).agg(F.min("metric_ts").alias("_lo"), F.max("metric_ts").alias("_hi"))
    spine = spans.select(*SERIES_KEYS, F.explode(F.sequence("_lo", "_hi", step)).alias("metric_ts"))
    full = spine.join(bars, SERIES_KEYS + ["metric_ts"], "left")
    return full.select(
        *SERIES_KEYS, "metric_ts", F.to_date("metric_ts").alias("metric_date"),
        "open_price", "high_price", "low_price", "close_price",
        F.coalesce("base_volume", F.lit(0).cast(bars.schema["base_volume"].dataType)).alias("base_volume"),
        F.coalesce("trade_count", F.lit(0)).alias("trade_count"), "vwap")


def depth_bars(depth: DataFrame, bucket: str = "minute", exact_median: bool = False,
               accuracy: int = 10000) -> DataFrame:
    """A4-A5 (int_depth_1m): avg spread bps, avg mid and median mid per bucket.

    The median is ``percentile_approx`` (bounded memory per group, like the
    warehouse's approximate quantiles).  ``exact_median=True`` uses the exact
    discrete median instead, which buffers each group's values.
    """
    med = (F.percentile_approx("mid_price", 0.5, accuracy) if not exact_median
           else F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY mid_price)"))
    g = (depth.groupBy(*SERIES_KEYS, _bucket("event_ts", bucket).alias("metric_ts"))
         .agg(F.avg("spread_bps").alias("avg_spread_bps"),
              F.avg("mid_price").alias("avg_mid_price"),
              med.cast(depth.schema["mid_price"].dataType).alias("median_mid_price")))
    return g.withColumn("metric_date", F.to_date("metric_ts")).select(*DEPTH_1M_COLUMNS)


def dlq_bars(bronze: DataFrame, bucket: str = "minute") -> DataFrame:
    """A6 (int_dlq_1m): dead letters per bucket of broker time."""
    g = (bronze.filter(F.col("kafka_topic").like(DLQ_TOPIC_LIKE))
         .groupBy(_bucket("kafka_ts", bucket).alias("metric_ts"))
         .agg(F.count(F.lit(1)).alias("dead_letter_count")))
    return g.withColumn("metric_date", F.to_date("metric_ts")).select(*DLQ_1M_COLUMNS)
