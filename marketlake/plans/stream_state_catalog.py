"""Queries of the committed bronze table (K1-K5, Z1, Z2, Q66) and of streams with keyed state (Z3, W1-W5, G1-G3) on the events feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.bronze import to_bronze
from marketlake.operators.candles import candle_bars
from marketlake.operators.staging import stg_trades
from marketlake.plans.oracle import TRADE_DEC, _bars, _gold, as_double, r6, with_events
from marketlake.plans.pipeline import events_bronze
from marketlake.plans.present import present
from marketlake.plans.quality_catalog import reg
from marketlake.schemas import TOPIC_DLQ
from marketlake.session import ensure_conf, scratch_path, stored_table
from marketlake.sources.adapters import events_as_kafka
from marketlake.streaming import jobs as Z
from marketlake.streaming.bronze_table import RowCheck, compact_days, read_bronze_table, required, start_bronze_table, violations
from marketlake.streaming.state import latest_rolling, open_trades, stream_best_trades, stream_rolling

WATERMARK = "1 hour"
BRONZE_SELECT = ["stream_kind", "exchange", "symbol", "event_ts_ms", "ingest_ts", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts", "dt"]


def hot_series(records: DataFrame) -> DataFrame:
    """A third of the trades and books in one series."""
    hot = (F.col("topic") != TOPIC_DLQ) & (F.floor(F.col("offset") / 2) % 3 == 0)
    renamed = F.regexp_replace(F.regexp_replace("value", '"venue":"v[0-9]"', '"venue":"hot"'), '"symbol":"S[0-9]/USD"', '"symbol":"HOT/USD"')
    return records.withColumn("value", F.when(hot, renamed).otherwise(F.col("value")))


def forget_last_commit(spark: SparkSession, checkpoint: str) -> None:
    """Leave a checkpoint as a crash between a batch's write and its commit does: the batch will run again under its id."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{done[-1]}"), False)


def ingest_with_crash(spark: SparkSession, records: DataFrame, base: str) -> str:
    """Half of the records in several batches, a crash before the last commit, a restart with the rest, and a compaction."""
    log, table, checkpoint = f"{base}/log", f"{base}/table", f"{base}/_ckpt"
    records = stored_table(records, "records")
    files = [0]
    for k in range(4):
        # as many files as the input asks for; a batch is about one of the four parts
        records.filter(F.pmod(F.col("offset"), F.lit(4)) == k).write.mode("append").parquet(log)
        files.append(len(spark.read.parquet(log).inputFiles()))
        if k % 2:
            batch = max(1, -(-(files[k + 1] - files[k - 1]) // 2))
            start_bronze_table(Z.read_records_stream(spark, log, max_files_per_trigger=batch), table, checkpoint, available_now=True).awaitTermination()
        if k == 1:
            forget_last_commit(spark, checkpoint)
    compact_days(spark, table, "2024-01-05", "2024-01-06")
    return table


@reg("z1_committed_batches_hot_series", with_events() + """
SELECT stream_kind, CASE WHEN hot THEN 'hot' ELSE exchange END AS exchange, CASE WHEN hot THEN 'HOT-USD' ELSE symbol END AS symbol,
       event_ts_ms, ingest_ts, kafka_topic, kafka_partition, kafka_offset, kafka_ts, dt
FROM (SELECT *, stream_kind <> 'dlq' AND (kafka_offset // 2) % 3 = 0 AS hot FROM bronze)""")
def _z1c(s, sf):
    """A hot series, a repeated batch id, a restart and a compaction: every record once."""
    ensure_conf(s)
    table = ingest_with_crash(s, hot_series(events_as_kafka(s, sf)), scratch_path(s, "z1c"))
    return present(read_bronze_table(s, table).select(*BRONZE_SELECT))


@reg("k5_q66_checks_while_writing", with_events() + """
SELECT 'event_ts_ms_not_null' AS check_name, count(*) FILTER (WHERE event_ts_ms IS NULL) AS failures FROM bronze
UNION ALL SELECT 'known_symbol', count(*) FILTER (WHERE symbol = 'unknown') FROM bronze
UNION ALL SELECT 'first_half', count(*) FILTER (WHERE dt > '2024-01-15') FROM bronze
UNION ALL SELECT 'rows_kept', count(*) FILTER (WHERE dt <= '2024-01-15') FROM bronze""")
def _k5w(s, sf):
    """Checks counted by the query that writes; rows that a dropping check finds don't arrive."""
    ensure_conf(s)
    base = scratch_path(s, "k5w")
    events_as_kafka(s, sf).repartition(4).write.parquet(f"{base}/log")
    checks = [*required(["event_ts_ms"], "warn"), RowCheck("known_symbol", F.col("symbol") == "unknown"), RowCheck("first_half", F.col("dt") > "2024-01-15", "drop")]
    records = Z.read_records_stream(s, f"{base}/log", max_files_per_trigger=2)
    start_bronze_table(records, f"{base}/table", f"{base}/_ckpt", available_now=True, checks=checks).awaitTermination()
    kept = read_bronze_table(s, f"{base}/table").agg(F.lit("rows_kept").alias("check_name"), F.count(F.lit(1)).alias("failures"))
    return violations(s, f"{base}/table").unionByName(kept)


def drain_by_arrival(rows: DataFrame, arrival: F.Column, days: int, log: str, drain: Callable[[], None]) -> None:
    """``rows`` written to ``log``, ``days`` days of arrival at a time and in that order; after each, ``drain`` runs the stream over what is new.

    The rows are dealt to a folder for each of these times in one pass, so each is written by as many tasks as its size asks for,
    and nothing of the others is read for it.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "arrivals")
    dealt = rows.withColumn("_part", F.floor(F.datediff(arrival, F.lit("2024-01-01")) / days)).filter("_part IS NOT NULL")
    dealt.hint("rebalance", "_part").write.partitionBy("_part").parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    for part in sorted(r[0] for r in dealt.select("_part").distinct().collect()):
        dealt.filter(F.col("_part") == part).drop("_part").write.mode("append").parquet(log)
        drain()


def replays_that_differ(records: DataFrame) -> DataFrame:
    """Replays (odd offsets) say another quantity than the first delivery."""
    other = F.regexp_replace("value", '"quantity":"', '"quantity":"1')
    return records.withColumn("value", F.when(F.col("offset") % 2 == 1, other).otherwise(F.col("value")))


_DIFFERENT = "CAST(CAST(CASE WHEN copy = 2 THEN '1' ELSE '' END || CAST(k AS VARCHAR) AS BIGINT) AS DECIMAL(20, 9)) AS p_qty"


@reg("z3_best_delivery_of_trades", as_double(with_events().replace("CAST(k AS DECIMAL(20, 9)) AS p_qty", _DIFFERENT) + "\nSELECT * FROM stg_trades", TRADE_DEC))
def _z3b(s, sf):
    """Replays arrive half an hour later, some in a later batch, and say something else; the stream keeps what the batch keeps."""
    ensure_conf(s)
    base = scratch_path(s, "z3b")
    records = replays_that_differ(events_as_kafka(s, sf))
    arrival = F.col("timestamp") + F.when(F.col("offset") % 2 == 1, F.expr("interval 30 minutes")).otherwise(F.expr("interval 0 minutes"))

    def drain():
        bronze = to_bronze(Z.read_records_stream(s, f"{base}/log"))
        Z.run_available_now(stream_best_trades(bronze, WATERMARK, WATERMARK), f"{base}/z3", f"{base}/_ckpt")

    drain_by_arrival(records, arrival, 5, f"{base}/log", drain)
    done = s.read.parquet(f"{base}/z3")
    return present(done.unionByName(open_trades(s, f"{base}/_ckpt")))


@reg("w1_w5_stream_rolling_minute", with_events(_bars("minute"), _gold()) + f"""
SELECT exchange, symbol, metric_ts, CAST(close_price AS DOUBLE) AS close_price, {r6("rolling_avg_close_5m")}, {r6("move", "log_close_return")},
       {r6("volatility")}, {r6("volatility_60m")}, c.zero_volume_flag, c.price_spike_flag, c.zero_volume_flag OR c.price_spike_flag AS anomaly_flag
FROM candles_f c JOIN moves USING (exchange, symbol, metric_ts) JOIN (SELECT exchange, symbol, metric_ts, volatility, volatility_60m FROM gold)
     USING (exchange, symbol, metric_ts)""")
def _w15(s, sf):
    """Minute bars in ten batches, a seventh of them six hours late: rolling values from the ring of each series."""
    base = scratch_path(s, "w15")
    bars = candle_bars(stg_trades(events_bronze(s, sf)), "minute")
    late = F.pmod(F.xxhash64("metric_ts"), F.lit(7)) == 0
    arrival = F.col("metric_ts") + F.when(late, F.expr("interval 6 hours")).otherwise(F.expr("interval 0 hours"))

    def drain():
        stream = s.readStream.schema(bars.schema).parquet(f"{base}/log")
        Z.run_available_now(stream_rolling(stream), f"{base}/rolling", f"{base}/_ckpt")

    drain_by_arrival(bars, arrival, 3, f"{base}/log", drain)
    return present(latest_rolling(s.read.parquet(f"{base}/rolling")), round6=("rolling_avg_close_5m", "log_close_return", "volatility", "volatility_60m"))
