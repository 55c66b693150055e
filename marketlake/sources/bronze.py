"""Bronze Parquet table: Hive-partitioned by dt / symbol / exchange."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.schemas import BRONZE, BRONZE_PARTITION_COLUMNS
from marketlake.session import ensure_conf


def read_bronze(spark: SparkSession, base: str, dt_from: str | None = None, dt_to: str | None = None,
                require_partition_filter: bool = False) -> DataFrame:
    """Explicit schema, partition values kept as STRING.

    ``dt_from``/``dt_to`` become ``PartitionFilters`` (directory pruning).
    ``require_partition_filter`` mirrors the warehouse's optional mandatory
    partition filter: without a dt range the read is refused.
    """
    ensure_conf(spark)
    if require_partition_filter and not (dt_from or dt_to):
        raise ValueError("bronze read needs a dt range (require_partition_filter=True)")
    df = spark.read.schema(BRONZE).option("basePath", base).parquet(base)
    if dt_from:
        df = df.filter(F.col("dt") >= dt_from)
    if dt_to:
        df = df.filter(F.col("dt") <= dt_to)
    return df


def write_bronze_batch(bronze: DataFrame, base: str, mode: str = "append",
                       max_records_per_file: int | None = None, layout: str = "hive", replace: str = "static") -> None:
    """K1/K2 (batch form): append bronze rows.

    ``layout="hive"`` writes ``dt=/symbol=/exchange=`` directories (the
    upstream layout, readable by existing consumers).  With many series and a
    long history that is one directory per (day, series) -- e.g. 64 series x
    7 years = 160k small directories -- so ``layout="daily"`` writes ``dt=``
    directories only, rows sorted by (symbol, exchange) inside each file so
    Parquet min/max statistics still skip other series.  ``read_bronze``
    reads both (symbol and exchange are data columns in the daily layout).
    ``layout="flat"`` writes no directories at all (for long, sparse
    histories where even one directory per day means tiny files).

    Rows are shuffled with a REBALANCE on the directory keys: each writer
    gets whole directories (few files each), AQE merges small partitions and
    splits a skewed one (a hot day or symbol) over several writers, with no
    sampling pass over the input.

    With ``mode="overwrite"``, ``replace`` says what goes: everything
    (``static``) or only the directories that are written (``dynamic``),
    whatever the session's setting.
    """
    if layout == "flat":
        # One directory; each file holds whole days sorted by (dt, symbol,
        # exchange), so dt/symbol filters prune by Parquet statistics instead
        # of paths.  REBALANCE (not a range repartition) avoids a sampling
        # pass that would recompute the whole input.
        w = (bronze.hint("rebalance", "dt")
             .sortWithinPartitions("dt", "symbol", "exchange", "kafka_topic", "kafka_partition", "kafka_offset")
             .write.mode(mode))
    else:
        keys = BRONZE_PARTITION_COLUMNS if layout == "hive" else ["dt"]
        w = (bronze.hint("rebalance", *keys)
             .sortWithinPartitions("dt", "symbol", "exchange", "kafka_topic", "kafka_partition", "kafka_offset")
             .write.mode(mode).partitionBy(*keys))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.option("partitionOverwriteMode", replace).parquet(base)


def count_parquet(spark: SparkSession, path: str) -> int:
    """Row count of a Parquet prefix (answered from footers when possible)."""
    return spark.read.parquet(path).count()


def count_table(spark: SparkSession, name: str) -> int:
    """Row count of a catalog table."""
    return spark.table(name).count()


PUBLISHED = "dt string, row_count bigint, published_at timestamp"


def publish_days(spark: SparkSession, landing: str, table: str, dt_from: str, dt_to: str, layout: str = "hive") -> None:
    """K2/K3: rewrite the days ``[dt_from, dt_to]`` of the streaming sink's
    ``landing`` folder as few large files in ``table/data``.

    The sink keeps a log of the files it wrote, which its readers follow, so
    the landing folder is never touched; it stays the full record.  Only the
    day directories that are written are replaced, from all that landing
    holds for them, so publishing a day again is safe and picks up late rows.
    When the data is in place, ``table/published`` gets one row per day with
    its row count -- the commit marker that readers go by.
    """
    days = read_bronze(spark, landing, dt_from, dt_to)
    write_bronze_batch(days, f"{table}/data", mode="overwrite", layout=layout, replace="dynamic")
    # the counts come from what was written, not from a landing folder that may have grown
    counts = read_bronze(spark, f"{table}/data", dt_from, dt_to).groupBy("dt").agg(F.count(F.lit(1)).alias("row_count"))
    counts.withColumn("published_at", F.current_timestamp()).write.mode("append").parquet(f"{table}/published")


def published_days(spark: SparkSession, table: str) -> DataFrame:
    """K3: ``dt, row_count`` as last published."""
    try:
        log = spark.read.schema(PUBLISHED).parquet(f"{table}/published")
    except AnalysisException:  # nothing published yet
        return spark.createDataFrame([], "dt string, row_count bigint")
    last = log.groupBy("dt").agg(F.max_by("row_count", "published_at").alias("row_count"))
    return last


def stale_days(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """``dt`` of published days that have got more rows in ``landing`` since."""
    now = read_bronze(spark, landing).groupBy("dt").agg(F.count(F.lit(1)).alias("landed"))
    return now.join(published_days(spark, table), "dt").filter("landed <> row_count").select("dt")


def read_bronze_published(spark: SparkSession, landing: str, table: str, dt_from: str | None = None,
                          dt_to: str | None = None) -> DataFrame:
    """Every bronze row once: published days from the table, all others from landing."""
    days = published_days(spark, table).select("dt")
    open_days = read_bronze(spark, landing, dt_from, dt_to).join(days, "dt", "left_anti")
    if days.isEmpty():
        return open_days
    return read_bronze(spark, f"{table}/data", dt_from, dt_to).unionByName(open_days)
