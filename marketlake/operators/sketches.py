"""Book roll-ups from mergeable sketches.

Per series and minute the quantile sketch (KLL) of the mid price, the sums and the count are stored once. Hours and days, or any
coarser bucket, are merges of these rows; raw books are not read again. A sketch holds about ``3 * k`` numbers however many books its
bucket had, and merging keeps its error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import safe_divide
from marketlake.operators.candles import BUCKETS
from marketlake.schemas import DEPTH_1M_COLUMNS, SERIES_KEYS
from marketlake.session import ensure_conf

#: Size parameter of the sketches; ``rank_error`` is 0.07 % for it. Up to k values a sketch is exact.
K = 4096


def rank_error(k: int = K) -> float:
    """The part of all values by which a median's rank may be off, in 99 of 100 cases (of sketches of any number of merges)."""
    return 2.296 / k**0.9723


def depth_sketches(depth: DataFrame, bucket: str = "minute", k: int = K) -> DataFrame:
    """Staged books -> ``exchange, symbol, metric_ts, metric_date, books, sum_spread_bps, sum_mid_price, mid_sketch``."""
    if bucket not in BUCKETS:
        raise ValueError(f"bucket must be one of {BUCKETS}")
    g = depth.groupBy(*SERIES_KEYS, F.date_trunc(bucket, F.col("event_ts")).alias("metric_ts")).agg(*_sketch_columns(k))
    return g.select(*SERIES_KEYS, "metric_ts", F.to_date("metric_ts").alias("metric_date"), "books", "sum_spread_bps", "sum_mid_price", "mid_sketch")


def _sketch_columns(k: int) -> list[F.Column]:
    return [F.count(F.lit(1)).alias("books"), F.sum("spread_bps").alias("sum_spread_bps"), F.sum("mid_price").alias("sum_mid_price"),
            F.kll_sketch_agg_double(F.col("mid_price").cast("double"), F.lit(k)).alias("mid_sketch")]


def depth_bars_from_sketches(sketches: DataFrame, bucket: str, k: int = K) -> DataFrame:
    """``depth_bars`` columns at ``bucket``, which is not finer than the sketches'."""
    if bucket not in BUCKETS:
        raise ValueError(f"bucket must be one of {BUCKETS}")
    g = sketches.groupBy(*SERIES_KEYS, F.date_trunc(bucket, F.col("metric_ts")).alias("_ts")).agg(
        F.sum("books").alias("n"), F.sum("sum_spread_bps").alias("s"), F.sum("sum_mid_price").alias("m"), F.kll_merge_agg_double("mid_sketch", F.lit(k)).alias("q"))
    return g.select(
        *SERIES_KEYS, F.col("_ts").alias("metric_ts"), F.to_date("_ts").alias("metric_date"), safe_divide("s", F.col("n").cast("double")).alias("avg_spread_bps"),
        safe_divide("m", F.col("n").cast("decimal(20,0)")).alias("avg_mid_price"),
        F.kll_sketch_get_quantile_double("q", F.lit(0.5)).cast("decimal(38,10)").alias("median_mid_price")).select(*DEPTH_1M_COLUMNS)


def write_sketches(sketches: DataFrame, path: str, mode: str = "append") -> None:
    """Day directories, as gold has them."""
    sketches.hint("rebalance", "metric_date").write.mode(mode).partitionBy("metric_date").parquet(path)


def read_sketches(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The stored sketches of some days; the bounds prune directories."""
    ensure_conf(spark)
    df = spark.read.parquet(path)
    if date_from:
        df = df.filter(F.col("metric_date") >= date_from)
    if date_to:
        df = df.filter(F.col("metric_date") <= date_to)
    return df.withColumn("metric_date", F.col("metric_date").cast("date"))


def stream_depth_sketches(books: DataFrame, k: int = K) -> DataFrame:
    """The minute sketches of a stream of valid books with a watermark on ``event_ts``; each closed minute is one row."""
    g = books.groupBy(*SERIES_KEYS, F.window("event_ts", "1 minute").alias("w")).agg(*_sketch_columns(k))
    return g.select(*SERIES_KEYS, F.col("w.start").alias("metric_ts"), F.to_date("w.start").alias("metric_date"), "books", "sum_spread_bps", "sum_mid_price",
                    "mid_sketch")
