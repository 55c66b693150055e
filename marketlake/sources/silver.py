"""Silver tables: staged trades and books by event date (K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import ensure_conf


def write_silver(staged: DataFrame, path: str, mode: str = "append") -> None:
    """Day directories by ``event_ts``; an overwrite replaces the whole table."""
    (staged.withColumn("event_date", F.date_format("event_ts", "yyyy-MM-dd")).hint("rebalance", "event_date")
     .write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(path))


def read_silver(spark: SparkSession, path: str, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Rows of the days ``[date_from, date_to]`` (literals on the partition column, so directories are pruned)."""
    ensure_conf(spark)
    df = spark.read.parquet(path)
    if date_from:
        df = df.filter(F.col("event_date") >= date_from)
    if date_to:
        df = df.filter(F.col("event_date") <= date_to)
    return df.drop("event_date")
