"""Gold mart fct_market_metrics (J1, J2, W1-W5, G1-G4) and its writer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import safe_divide, safe_ln
from marketlake.operators.candles import (
    candle_bars, depth_bars, dlq_bars, flag_columns, rollup_columns, series_window,
)
from marketlake.schemas import GOLD_COLUMNS, SERIES_KEYS, VOLATILITY_LONG_ROWS, VOLATILITY_ROWS


def gold_from_bars(bars: DataFrame, depth_1m: DataFrame, dlq_1m: DataFrame) -> DataFrame:
    """Join candles with book and dead-letter roll-ups, then add every
    series-window column in one Window pass.

    * J1 is a left join on (exchange, symbol, metric_ts): both sides come out
      of aggregations hash-partitioned on exactly these keys, so the join
      reuses that partitioning.
    * J2 joins dead letters on the bucket only (every series of that minute
      gets the full count -- the reference's grain).  The right side has one
      row per minute; AQE broadcasts it when its measured size is small and
      keeps a shuffle join otherwise.
    * W1 (rolling close) is moved after the joins: left joins on unique keys
      keep the candle rows unchanged, so it can share the partition/sort of
      W2-W5 -- one shuffle on (exchange, symbol) and one sort in total.
    """
    d = depth_1m.select(*SERIES_KEYS, "metric_ts", "avg_spread_bps", "avg_mid_price", "median_mid_price")
    q = dlq_1m.select("metric_ts", "dead_letter_count")
    joined = (bars.join(d, SERIES_KEYS + ["metric_ts"], "left")
              .join(q, "metric_ts", "left")
              .withColumn("dead_letter_count", F.coalesce("dead_letter_count", F.lit(0)).cast("bigint")))
    prev = F.lag("close_price").over(series_window())
    ret = safe_ln(safe_divide(F.col("close_price").cast("double"), prev.cast("double")))
    with_ret = joined.select("*", *rollup_columns(), ret.alias("log_close_return"))
    vol = with_ret.select(
        "*", *flag_columns(),
        F.stddev_samp("log_close_return").over(series_window((-(VOLATILITY_ROWS - 1), 0)))
        .alias("volatility"),
        F.stddev_samp("log_close_return").over(series_window((-(VOLATILITY_LONG_ROWS - 1), 0)))
        .alias("volatility_60m"))
    return vol.select(
        *SERIES_KEYS, "metric_ts", "metric_date",
        F.col("open_price").alias("open"), F.col("high_price").alias("high"),
        F.col("low_price").alias("low"), F.col("close_price").alias("close"),
        F.col("base_volume").alias("volume"), "vwap", F.col("avg_spread_bps").alias("spread_bps"),
        "volatility", "volatility_60m", "dead_letter_count", "zero_volume_flag",
        "price_spike_flag", "anomaly_flag", "trade_count", "avg_mid_price", "median_mid_price",
    ).select(*GOLD_COLUMNS)


def market_metrics(trades: DataFrame, depth: DataFrame, bronze: DataFrame,
                   bucket: str = "minute", exact_median: bool = False) -> DataFrame:
    """fct_market_metrics from staged trades, staged depth and bronze."""
    return gold_from_bars(candle_bars(trades, bucket),
                          depth_bars(depth, bucket, exact_median=exact_median),
                          dlq_bars(bronze, bucket))


def read_gold(spark, path: str) -> DataFrame:
    """Gold table as written by :func:`write_gold`; partition values are kept
    as strings session-wide, so ``metric_date`` is cast back to DATE (a
    filter on it still prunes day directories)."""
    return spark.read.parquet(path).withColumn("metric_date", F.col("metric_date").cast("date")) \
        .select(*GOLD_COLUMNS)


def write_gold(gold: DataFrame, path: str, mode: str = "overwrite", layout: str = "daily",
               replace: str = "static") -> None:
    """Day partitions, rows clustered by (symbol, exchange) inside files.

    A REBALANCE on ``metric_date`` gives each day to one writer (one file
    per day) and lets AQE split an oversized day across several writers;
    files are sorted by (symbol, exchange, metric_ts) for row-group
    skipping.  An overwrite replaces the whole table, or with
    ``replace="dynamic"`` only the days that are written, whatever the
    session's setting.  ``layout="flat"`` skips the day directories (files hold
    whole days, sorted) for long, sparse histories.
    """
    if layout == "flat":
        (gold.hint("rebalance", "metric_date")
         .sortWithinPartitions("metric_date", "symbol", "exchange", "metric_ts")
         .write.mode(mode).parquet(path))
        return
    (gold.hint("rebalance", "metric_date")
     .sortWithinPartitions("metric_date", "symbol", "exchange", "metric_ts")
     .write.mode(mode).option("partitionOverwriteMode", replace).partitionBy("metric_date").parquet(path))
