"""Queries on stored sketches: book medians at three grains (A4, A5, Z5) and distinct counts per day (Q41-Q44, Q48g, Q50)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from marketlake.operators.sketches import depth_bars_from_sketches, depth_sketches, read_sketches, stream_depth_sketches, write_sketches
from marketlake.operators.staging import stg_depth
from marketlake.plans.oracle import with_events
from marketlake.plans.pipeline import events_bronze
from marketlake.plans.quality_catalog import reg
from marketlake.quality.distinct import distinct_count_holds, distinct_ratio_holds, refresh_sketches
from marketlake.session import ensure_conf, scratch_path
from marketlake.sources.bronze import write_bronze_batch
from marketlake.streaming import jobs as Z

GRAINS = ("minute", "hour", "day")


def _grain_sql(grain: str) -> str:
    return f"""
SELECT '{grain}' AS grain, exchange, symbol, date_trunc('{grain}', event_ts) AS metric_ts, CAST(date_trunc('{grain}', event_ts) AS DATE) AS metric_date,
       avg(spread_bps) AS avg_spread_bps, avg(CAST(mid_price AS DOUBLE)) AS avg_mid_price, CAST(quantile_disc(mid_price, 0.5) AS DOUBLE) AS median_mid_price
FROM stg_depth GROUP BY ALL"""


_ROUND = ("avg_spread_bps", "avg_mid_price")


def _at_grains(spark, path: str):
    """Every grain from the one stored table."""
    grains = [depth_bars_from_sketches(read_sketches(spark, path), g).withColumn("grain", F.lit(g)) for g in GRAINS]
    return reduce(lambda a, b: a.unionByName(b), grains)


@reg("a5_sketch_medians_three_grains", with_events() + " UNION ALL ".join(map(_grain_sql, GRAINS)), round6=_ROUND)
def _a5(s, sf):
    """Medians of minutes, hours and days from the same minute sketches."""
    path = scratch_path(s, "a5")
    write_sketches(depth_sketches(stg_depth(events_bronze(s, sf))), path)
    return _at_grains(s, path)


@reg("z5_stream_sketch_medians", with_events() + _grain_sql("day"), round6=_ROUND)
def _z5s(s, sf):
    """The minute sketches of the stream, and of the minutes that it left open, merged to days."""
    ensure_conf(s)
    base = scratch_path(s, "z5s")
    write_bronze_batch(events_bronze(s, sf), f"{base}/bronze")
    books = Z.stream_valid_books(Z.read_bronze_stream(s, f"{base}/bronze"), "1 hour")
    Z.run_available_now(stream_depth_sketches(books), f"{base}/minutes", f"{base}/_ckpt", partition_by=["metric_date"])
    done = read_sketches(s, f"{base}/minutes")
    whole = Z.with_open_windows(s, done, f"{base}/bronze", lambda b: depth_sketches(stg_depth(b)), f"{base}/_ckpt", "minute")
    return depth_bars_from_sketches(whole, "day").withColumn("grain", F.lit("day"))


COUNTS = [("exchange", "=", 4), ("exchange", ">", 2), ("symbol", "<", 5), ("symbol", "=", 5), ("kafka_offset", ">", 1000), ("kafka_offset", "<", 1000),
          ("kafka_offset", ">=", 10_000_000), ("event_ts_ms", ">", 700), ("event_ts_ms", "<=", 9_900), ("kafka_partition", "=", 6), ("ingest_ts", "<", 10_100)]
RATIOS = [("kafka_offset", ">", 0.5), ("event_ts_ms", "<", 0.9), ("symbol", ">", 0.5), ("kafka_offset", "=", 0.9)]


def _counts_sql() -> str:
    parts = [f"SELECT 'count' AS kind, '{c}' AS column_name, '{op}' AS op, CAST({v} AS DOUBLE) AS value, count(DISTINCT {c}) {op} {v} AS holds FROM bronze"
             for c, op, v in COUNTS]
    parts += [f"SELECT 'ratio', '{c}', '{op}', CAST({v} AS DOUBLE), count(DISTINCT {c}) {op} {v} * count({c}) FROM bronze" for c, op, v in RATIOS]
    return "\nUNION ALL ".join(parts)


@reg("q41_q50_sketched_distinct_counts", with_events() + "\n" + _counts_sql())
def _q41s(s, sf):
    """Sketches of two loads: the second changes some days, and only these are read again."""
    ensure_conf(s)
    base, columns = scratch_path(s, "q41s"), ["exchange", "symbol", "kafka_offset", "event_ts_ms", "kafka_partition", "ingest_ts"]
    b = events_bronze(s, sf)
    late = (F.col("dt") >= "2024-01-20") & (F.pmod(F.xxhash64("kafka_offset"), F.lit(2)) == 0)
    for part in (b.filter(~late), b.filter(late)):
        write_bronze_batch(part, f"{base}/bronze", layout="daily")
        refresh_sketches(s, f"{base}/bronze", f"{base}/sketches", columns)
    counts = distinct_count_holds(s, f"{base}/bronze", f"{base}/sketches", COUNTS).withColumn("kind", F.lit("count"))
    ratios = distinct_ratio_holds(s, f"{base}/bronze", f"{base}/sketches", RATIOS).withColumn("kind", F.lit("ratio"))
    return counts.unionByName(ratios).select("kind", "column_name", "op", "value", "holds")
