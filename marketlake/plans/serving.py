"""Serving queries on the gold mart (V1-V14): dashboard panels, the DLQ
alert and reconciliation.  Every "last N" query takes an explicit ``now``.

Time filters are on ``metric_ts``; each one also adds the implied filter on
the day-partition column ``metric_date`` so a partitioned gold table is
pruned to the touched days (``PartitionFilters`` in the scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schemas import DLQ_ALERT_THRESHOLD


def _now(now) -> Column:
    return F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()


def since(gold: DataFrame, now, amount: int, unit: str = "DAY") -> DataFrame:
    """Rows with ``metric_ts >= now - amount unit`` (+ the partition filter)."""
    lo = F.timestamp_add(unit, F.lit(-amount), _now(now))
    return gold.filter((F.col("metric_date") >= F.to_date(lo)) & (F.col("metric_ts") >= lo))


def _series_label() -> Column:
    return F.concat(F.col("exchange"), F.lit(":"), F.col("symbol"))


def candlestick(gold, exchange, symbol, now, days=2):
    """V1: OHLC of one series for the last ``days``, in time order."""
    g = since(gold, now, days).filter((F.col("exchange") == exchange) & (F.col("symbol") == symbol))
    return g.select(F.col("metric_ts").alias("time"), *[F.col(c).cast("double").alias(c)
                                                         for c in ("open", "high", "low", "close")]).orderBy("time")


def volume_by_series(gold, now, days=2):
    """V2: volume per ``exchange:symbol`` series."""
    return since(gold, now, days).select(F.col("metric_ts").alias("time"), _series_label().alias("metric"),
                                         F.col("volume").cast("double").alias("volume")).orderBy("time")


def spread_series(gold, now, days=2):
    """V3: non-NULL spread per series."""
    return since(gold, now, days).filter(F.col("spread_bps").isNotNull()).select(
        F.col("metric_ts").alias("time"), _series_label().alias("metric"),
        F.col("spread_bps").cast("double").alias("spread_bps")).orderBy("time")


def vwap_vs_mid(gold, exchange, symbol, now, days=2):
    """V4: VWAP and mid price of one series in long format.  One scan and a
    ``stack`` unpivot instead of a UNION ALL of two scans."""
    g = since(gold, now, days).filter((F.col("exchange") == exchange) & (F.col("symbol") == symbol))
    return g.select(F.col("metric_ts").alias("time"), F.col("vwap").cast("double").alias("vwap"),
                    F.col("avg_mid_price").cast("double").alias("mid_price")) \
        .selectExpr("time", "stack(2, 'vwap', vwap, 'mid_price', mid_price) AS (metric, value)").orderBy("time")


def volatility_heatmap(gold, now, days=3):
    """V5: mean volatility by series and UTC hour of day."""
    return (since(gold, now, days).filter(F.col("volatility").isNotNull())
            .groupBy(_series_label().alias("symbol"), F.hour("metric_ts").alias("hour_of_day"))
            .agg(F.avg("volatility").cast("double").alias("volatility")).orderBy("symbol", "hour_of_day"))


def dlq_recent(gold, now, minutes=5):
    """V6: dead letters summed over the last ``minutes`` (as stored: each
    series row of a minute carries that minute's full count)."""
    return since(gold, now, minutes, "MINUTE").agg(
        F.max("metric_ts").alias("time"),
        F.coalesce(F.sum("dead_letter_count"), F.lit(0)).cast("double").alias("dlq_5m"))


def freshness_lag(gold, now):
    """V7: seconds between ``now`` and the newest metric."""
    return gold.agg(F.max("metric_ts").alias("_m")).select(
        _now(now).alias("time"),
        F.timestamp_diff("SECOND", F.col("_m"), _now(now)).cast("double").alias("freshness_lag_seconds"))


def rows_recent(gold, now, days=2):
    """V8: row count of the last ``days``."""
    return since(gold, now, days).agg(F.count(F.lit(1)).cast("double").alias("rows_2d")) \
        .select(_now(now).alias("time"), "rows_2d")


def latest_rows(gold, k=100, columns=("metric_ts", "exchange", "symbol", "close", "volume", "spread_bps",
                                      "volatility", "dead_letter_count")):
    """V9: the ``k`` newest rows (a top-k: each task keeps its best k).
    Ties on ``metric_ts`` are broken by series so the cut is deterministic."""
    return gold.orderBy(F.col("metric_ts").desc(), "exchange", "symbol").limit(k).select(*columns)


def health_rows(gold, k=200):
    """V9 (pipeline-health variant)."""
    return latest_rows(gold, k, ("metric_ts", "exchange", "symbol", "dead_letter_count", "anomaly_flag",
                                 "volume", "spread_bps", "volatility"))


def rows_per_series(gold, now, days=2):
    """Rows and newest timestamp per series, busiest first."""
    return (since(gold, now, days).groupBy("exchange", "symbol")
            .agg(F.count(F.lit(1)).alias("rows_2d"), F.max("metric_ts").alias("latest_ts"))
            .orderBy(F.col("rows_2d").desc(), "exchange", "symbol"))


def latest_epoch(gold):
    """Newest metric as epoch seconds."""
    return gold.agg(F.unix_timestamp(F.max("metric_ts")).cast("double").alias("latest_metric_ts_epoch"))


def total_rows(gold):
    """V11b."""
    return gold.agg(F.count(F.lit(1)).cast("double").alias("total_rows"))


def table_exists(spark, name: str) -> bool:
    """Catalog lookup (no data read)."""
    return spark.catalog.tableExists(name)


def dlq_alert(gold, now, threshold=DLQ_ALERT_THRESHOLD, minutes=5, per_minute=False):
    """Last-5-minute dead-letter sum against the threshold.

    ``per_minute=True`` counts each minute once (max over its series rows)
    before summing, removing the over-count of the stored grain.
    """
    g = since(gold, now, minutes, "MINUTE")
    if per_minute:
        g = g.groupBy("metric_ts").agg(F.max("dead_letter_count").alias("dead_letter_count"))
    v = g.agg(F.coalesce(F.sum("dead_letter_count"), F.lit(0)).cast("double").alias("value"))
    return v.select(_now(now).alias("time"), "value", (F.col("value") > threshold).alias("firing"))


def bronze_day_counts(bronze, dt_from, dt_to):
    """Rows per day for a dt range; on a partitioned bronze table the
    range is a ``PartitionFilters`` entry, so other days are never listed."""
    return (bronze.filter((F.col("dt") >= dt_from) & (F.col("dt") <= dt_to))
            .groupBy("dt").agg(F.count(F.lit(1)).alias("row_count")))


def reconcile_offsets(bronze, end_offsets: DataFrame | None = None, topics=None):
    """Per topic-partition offset coverage of bronze.

    ``expected = max - min + 1``; ``gaps = expected - distinct offsets``;
    ``duplicates = rows - distinct offsets``.  With broker end offsets
    (``topic, partition, end_offset``) the lag to the log end is added.
    Exact distinct counts are per (topic, partition) group, combined
    map-side by partial aggregation.
    """
    b = bronze if not topics else bronze.filter(F.col("kafka_topic").isin(list(topics)))
    r = (b.groupBy("kafka_topic", "kafka_partition")
         .agg(F.min("kafka_offset").alias("min_offset"), F.max("kafka_offset").alias("max_offset"),
              F.count_distinct("kafka_offset").alias("distinct_offsets"), F.count(F.lit(1)).alias("row_count")))
    r = (r.withColumn("expected_offsets", F.col("max_offset") - F.col("min_offset") + 1)
         .withColumn("gaps", F.col("expected_offsets") - F.col("distinct_offsets"))
         .withColumn("duplicates", F.col("row_count") - F.col("distinct_offsets")))
    if end_offsets is not None:
        e = end_offsets.select(F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"),
                               "end_offset")
        r = r.join(e, ["kafka_topic", "kafka_partition"], "full_outer").withColumn(
            "delta", F.col("end_offset") - F.coalesce("row_count", F.lit(0)))
    return r
