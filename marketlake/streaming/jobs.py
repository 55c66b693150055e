"""Streaming jobs.

* Z1/Z2/K1-K5 ``bronze_table.start_bronze_table``: Kafka (or any Kafka-shaped
  file source) -> bronze projection -> committed micro-batches in a
  Hive-partitioned Parquet table; hot series are split, repeated batches
  skipped, checks counted while writing.  ``start_bronze_ingest`` is the plain
  file sink for readers that follow its log.
* Z3 ``state.stream_best_trades``: staged trades, the best delivery of each
  (highest offset, as in the batch) held until the watermark has passed it.
  ``stream_trades`` emits the first delivery at once, where a stream of
  candles follows in the same query; it differs if a replay changed content.
* W1-W5/G1-G3 ``state.stream_rolling``: rolling values per series over closed
  bars, late ones included.
* Z4/Z5 ``stream_candles`` / ``stream_depth_bars`` / ``stream_dlq_bars``:
  tumbling windows in append mode; a window is emitted once the watermark
  passes its end.  Rolling (ROWS) windows cannot run on streams; gold is
  refreshed per micro-batch by Z6.
* Z6 ``refresh_gold_for_batch``: foreachBatch recomputation of what a batch
  changes, written with dynamic partition overwrite.
* Z7 ``repair_days``: rows that came after the watermark are dropped by the
  stream; this batch job finds them in bronze and applies them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import mid, notional, spread
from marketlake.operators.bronze import to_bronze
from marketlake.operators.candles import candle_bars, depth_bars, dlq_bars, tick_order
from marketlake.operators.dedup import first_per_key
from marketlake.operators.staging import parse_depth, parse_trades, stg_trades, valid_book, valid_trade
from marketlake.plans.gold import gold_from_bars, write_gold
from marketlake.schemas import (
    BRONZE, BRONZE_PARTITION_COLUMNS, DLQ_TOPIC_LIKE, KAFKA_RECORD, SERIES_KEYS, VOLATILITY_LONG_ROWS,
)
from marketlake.session import ensure_conf, stored_table
from marketlake.sources.bronze import read_bronze
from marketlake.sources.silver import read_silver, write_silver
from marketlake.streaming.state import last_watermark


def read_records_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Kafka-shaped records from a file source (used where no broker exists)."""
    r = spark.readStream.schema(KAFKA_RECORD).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def start_bronze_ingest(records: DataFrame, bronze_path: str, checkpoint: str,
                        trigger_seconds: int | None = 120, available_now: bool = False,
                        max_records_per_file: int | None = None, spread: int = 1):
    """Continuous bronze ingest through Spark's file sink.

    Rows of a day and series meet in ``spread`` tasks before the write, so a
    micro-batch writes that many files for each directory at most and not one for each Kafka
    partition and directory.  The file sink commits files and the checkpoint
    atomically per micro-batch, so a restart resumes from the last committed
    offsets without duplicates.  ``sources.bronze.publish_days`` compacts.
    The sink's query is planned without knowing sizes: ``bronze_table`` splits
    just the hot series instead of all by ``spread``.
    """
    ensure_conf(records.sparkSession)
    part = F.pmod(F.xxhash64("kafka_partition", "kafka_offset"), F.lit(spread))
    w = (to_bronze(records).repartition(*BRONZE_PARTITION_COLUMNS, *([part] if spread > 1 else [])).writeStream.format("parquet").outputMode("append")
         .partitionBy(*BRONZE_PARTITION_COLUMNS).option("checkpointLocation", checkpoint))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(bronze_path)


def read_bronze_stream(spark: SparkSession, bronze_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    ensure_conf(spark)
    r = spark.readStream.schema(BRONZE).option("basePath", bronze_path)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(bronze_path)


def stream_trades(bronze: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Z3: validated trades, duplicates dropped within the watermark."""
    t = parse_trades(bronze).withWatermark("event_ts", watermark).filter(valid_trade())
    return t.dropDuplicatesWithinWatermark(["exchange", "symbol", "trade_id"])


def _window(bucket: str) -> str:
    return {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}[bucket]


def stream_candles(trades: DataFrame, bucket: str = "minute") -> DataFrame:
    """Tumbling-window OHLCV (same columns as ``candle_bars``)."""
    pq = notional()
    g = (trades.groupBy(*SERIES_KEYS, F.window("event_ts", _window(bucket)).alias("w"))
         .agg(F.min_by("price", tick_order()).alias("open_price"), F.max("price").alias("high_price"),
              F.min("price").alias("low_price"), F.max_by("price", tick_order()).alias("close_price"),
              F.sum("quantity").alias("base_volume"), F.count(F.lit(1)).alias("trade_count"),
              F.sum(pq).alias("_notional")))
    return g.select(*SERIES_KEYS, F.col("w.start").alias("metric_ts"), F.to_date("w.start").alias("metric_date"),
                    "open_price", "high_price", "low_price", "close_price", "base_volume", "trade_count",
                    F.try_divide(F.col("_notional").cast("double"),
                                 F.nullif(F.col("base_volume"), F.lit(0)).cast("double")).alias("vwap"))


def stream_valid_books(bronze: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """T10-T13 on a stream: valid books with mid and spread, repeated deliveries dropped within the watermark."""
    d = parse_depth(bronze).withWatermark("event_ts", watermark)
    b, a = F.col("best_bid_price"), F.col("best_ask_price")
    return (d.withColumn("mid_price", mid(b, a)).filter(valid_book())
            .withColumn("spread_bps", 10000 * F.try_divide(spread(b, a).cast("double"), F.col("mid_price").cast("double")))
            .dropDuplicatesWithinWatermark(["kafka_topic", "kafka_partition", "kafka_offset"]))


def stream_depth_bars(bronze: DataFrame, bucket: str = "minute", watermark: str = "10 minutes") -> DataFrame:
    """Depth roll-up on a stream (approximate median).  ``operators.sketches``
    has the form whose minutes are merged to coarser buckets."""
    d = stream_valid_books(bronze, watermark)
    g = d.groupBy(*SERIES_KEYS, F.window("event_ts", _window(bucket)).alias("w")).agg(
        F.avg("spread_bps").alias("avg_spread_bps"), F.avg("mid_price").alias("avg_mid_price"),
        F.percentile_approx("mid_price", 0.5, 10000).cast("decimal(38,10)").alias("median_mid_price"))
    return g.select(*SERIES_KEYS, F.col("w.start").alias("metric_ts"), F.to_date("w.start").alias("metric_date"),
                    "avg_spread_bps", "avg_mid_price", "median_mid_price")


def stream_dlq_bars(bronze: DataFrame, bucket: str = "minute", watermark: str = "10 minutes") -> DataFrame:
    """Dead letters per window of broker time."""
    g = (bronze.filter(F.col("kafka_topic").like(DLQ_TOPIC_LIKE)).withWatermark("kafka_ts", watermark)
         .groupBy(F.window("kafka_ts", _window(bucket)).alias("w")).agg(F.count(F.lit(1)).alias("dead_letter_count")))
    return g.select(F.col("w.start").alias("metric_ts"), F.to_date("w.start").alias("metric_date"),
                    "dead_letter_count")


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, partition_by=None) -> None:
    """Drain everything available into Parquet (append mode) and stop."""
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(out_path)
    q.awaitTermination()


def stream_candles_available_now(spark: SparkSession, bronze_path: str, out: str, bucket: str = "minute",
                                 watermark: str = "10 minutes", max_files_per_trigger: int | None = None) -> str:
    """Bronze directory -> streamed candles written under ``out/candles``."""
    b = read_bronze_stream(spark, bronze_path, max_files_per_trigger)
    run_available_now(stream_candles(stream_trades(b, watermark), bucket), f"{out}/candles", f"{out}/_ckpt")
    return f"{out}/candles"


NEEDED = VOLATILITY_LONG_ROWS  # traded buckets whose values reach a row, besides its own


def _reach(spark: SparkSession, gold_path: str, touched: DataFrame, first: datetime.date, last: datetime.date) -> tuple[str, str]:
    """The days to read: from NEEDED stored buckets before each touched series'
    first touched bucket, to as many after its last one.

    Widens a range of days until every touched series has enough buckets in
    it or the table ends; each try reads only its days.
    """
    every = spark.read.parquet(gold_path)
    ends = every.agg(F.min("metric_date"), F.max("metric_date")).first()
    if ends[0] is None:
        return first.isoformat(), last.isoformat()
    table_first, table_last = (datetime.date.fromisoformat(str(d)) for d in ends)
    out = []
    for back in (True, False):
        days, edge = 1, first if back else last
        while True:
            far = edge - datetime.timedelta(days) if back else edge + datetime.timedelta(days)
            if far <= table_first if back else far >= table_last:
                break
            lo, hi = (far, last) if back else (first, far)
            rows = every.filter((F.col("metric_date") >= lo.isoformat()) & (F.col("metric_date") <= hi.isoformat()))
            outside = F.col("metric_ts") < F.col("first_ts") if back else F.col("metric_ts") > F.col("last_ts")
            counts = touched.join(rows.select(*SERIES_KEYS, "metric_ts"), SERIES_KEYS, "left") \
                .groupBy(*SERIES_KEYS).agg(F.count_if(outside).alias("n"))
            if counts.filter(F.col("n") < NEEDED).isEmpty():
                break
            days *= 2
        out.append(far.isoformat())
    return out[0], out[1]


def with_open_windows(spark: SparkSession, streamed: DataFrame, bronze_path: str, bars, checkpoint: str,
                      bucket: str) -> DataFrame:
    """The windows that a stopped stream has emitted, and those that its
    watermark had not passed yet, computed by ``bars(bronze)`` from the days
    that they can be in (the stream's last watermark says which)."""
    day = F.timestamp_millis(F.lit(last_watermark(spark, checkpoint))) - F.expr(f"interval {_window(bucket)}")
    since = spark.range(1).select(F.date_format(day, "yyyy-MM-dd")).first()[0]
    recent = bars(read_bronze(spark, bronze_path, dt_from=since)).select(*streamed.columns)
    keys = [c for c in (*SERIES_KEYS, "metric_ts") if c in streamed.columns]
    # the first day's windows may be cut by the day bound; those were emitted long ago
    return streamed.unionByName(recent.join(streamed.select(*keys), keys, "left_anti"))


def refresh_gold_for_batch(spark: SparkSession, trades_path: str, depth_path: str, bronze_path: str,
                           gold_path: str, batch: DataFrame, bucket: str = "minute",
                           exact_median: bool = False) -> None:
    """Recompute what the trades of ``batch`` (already in silver) change.

    A trade changes its candle, the next return and the rolling values of up
    to 60 later *traded* buckets of its series; their windows reach 60 traded
    buckets back.  Both bounds are found in the stored gold by counting
    buckets, so they fit sparse series too.  Touched series are recomputed
    from their first touched bucket on; all other rows of the rewritten days
    are copied.  Every input is read by literal bounds on its partition
    column.  Silver is de-duplicated by trade identity when read, so a batch
    that was appended twice changes nothing.
    """
    touched = stored_table(batch.groupBy(*SERIES_KEYS).agg(
        F.date_trunc(bucket, F.min("event_ts")).alias("first_ts"), F.date_trunc(bucket, F.max("event_ts")).alias("last_ts")),
        "touched")
    span = touched.agg(F.min("first_ts").cast("date"), F.max("last_ts").cast("date")).first()
    if span[0] is None:
        return
    lo, hi = _reach(spark, gold_path, touched, span[0], span[1])
    series = touched.select(*SERIES_KEYS)
    t = first_per_key(read_silver(spark, trades_path, lo, hi).join(series, SERIES_KEYS, "left_semi"),
                      [*SERIES_KEYS, "trade_id"],
                      [F.col(c).desc() for c in ("kafka_offset", "kafka_partition", "kafka_topic")])
    d = read_silver(spark, depth_path, lo, hi).join(series, SERIES_KEYS, "left_semi")
    b = read_bronze(spark, bronze_path, lo, hi)
    fresh = gold_from_bars(candle_bars(t, bucket), depth_bars(d, bucket, exact_median=exact_median), dlq_bars(b, bucket))
    # rows before the first touched bucket are there for the windows only
    fresh = fresh.join(touched.drop("last_ts"), SERIES_KEYS).filter("metric_ts >= first_ts").drop("first_ts")
    day = F.col("metric_date")
    old = spark.read.parquet(gold_path).filter((day >= span[0].isoformat()) & (day <= hi))
    replaced = old.join(touched.drop("last_ts"), SERIES_KEYS, "left")
    kept = replaced.filter("first_ts IS NULL OR metric_ts < first_ts").withColumn("metric_date", day.cast("date"))
    merged = stored_table(fresh.unionByName(kept.select(*fresh.columns)), "merged")
    write_gold(merged, gold_path, replace="dynamic")


def start_gold_refresh(trades_stream: DataFrame, spark: SparkSession, trades_path: str, depth_path: str,
                       bronze_path: str, gold_path: str, checkpoint: str, bucket: str = "minute",
                       trigger_seconds: int = 300, available_now: bool = False, exact_median: bool = False):
    """Z6 as a stream: each micro-batch of staged trades is appended to the
    silver table, then the gold rows that it changes are recomputed.  A batch
    that runs again after a failure is appended again; readers of silver
    count a trade once."""
    def each(batch: DataFrame, epoch_id: int):
        rows = stored_table(batch, f"epoch-{epoch_id}")  # computed once, used twice
        write_silver(rows, trades_path)
        refresh_gold_for_batch(spark, trades_path, depth_path, bronze_path, gold_path, rows, bucket, exact_median)

    w = trades_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def repair_days(spark: SparkSession, trades_path: str, depth_path: str, bronze_path: str, gold_path: str,
                dt_from: str, dt_to: str, bucket: str = "minute", exact_median: bool = False) -> None:
    """Trades of these days that are in bronze but not in silver (they
    came after the stream's watermark) are staged, appended and refreshed
    like a late batch."""
    have = read_silver(spark, trades_path, dt_from, dt_to).select(*SERIES_KEYS, "trade_id")
    late = stg_trades(read_bronze(spark, bronze_path, dt_from, dt_to)).join(have, [*SERIES_KEYS, "trade_id"], "left_anti")
    rows = stored_table(late, "late")
    write_silver(rows, trades_path)
    refresh_gold_for_batch(spark, trades_path, depth_path, bronze_path, gold_path, rows, bucket, exact_median)
