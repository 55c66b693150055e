"""Bronze as a table of committed micro-batches.

``start_bronze_table`` writes every micro-batch with a batch writer:

* Each batch goes to a folder of its own, ``data/batch=<query id>-<batch id>/dt=/symbol=/exchange=``, which a repeated try overwrites.
* The rows are dealt by a REBALANCE on the day and series, planned adaptively: small directories share a task, a hot one (a series
  with a third of the batch) is split over as many tasks as its size asks for. The file sink can't do that, as its query is planned once.
* When the data is in place, the batch's manifest is written: one row per day with its row count, and what the checks counted. A batch whose
  manifest is there is not written again, whatever the checkpoint says; one without is no part of the table. Query ids keep the batches
  of different checkpoints apart.
* Checks are counted by ``observe`` in the writing query itself, so they cost no second scan. A check of severity ``error`` that finds rows
  stops the batch before its manifest, ``warn`` only records its count, ``drop`` drops the rows (K5) and records how many. A task that runs
  again after the loss of an executor may count its rows again; whether there are bad rows isn't touched by that.

``compact_days`` rewrites the days of many batches into one folder and commits a manifest that replaces them; readers see either.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.bronze import to_bronze
from marketlake.schemas import BRONZE, BRONZE_COLUMNS
from marketlake.session import ensure_conf, stored_table
from marketlake.sources.bronze import write_bronze_batch

MANIFEST = ("batch string, dt string, row_count bigint, rows_in bigint, violations map<string, bigint>, replaced array<string>, "
            "committed_at timestamp")
#: Days and batches that a reader names by path; beyond that it lists the table's folder and joins.
MAX_PATHS = 20_000
SEVERITIES = ("warn", "error", "drop")


@dataclass(frozen=True)
class RowCheck:
    """A condition that bad rows fulfil, and what follows from finding some."""

    name: str
    violated: Column
    severity: str = "warn"

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}")


class BatchRefused(Exception):
    """A check of severity ``error`` found rows; the batch is not committed."""


def required(columns: list[str], severity: str = "drop") -> list[RowCheck]:
    """K5/Q20: one check per column that must not be NULL."""
    return [RowCheck(f"{c}_not_null", F.col(c).isNull(), severity) for c in columns]


def _manifest_path(table: str, batch: str) -> str:
    return f"{table}/manifest/entry={batch}"


def _is_committed(spark: SparkSession, table: str, batch: str) -> bool:
    try:
        return not spark.read.schema(MANIFEST).parquet(_manifest_path(table, batch)).isEmpty()
    except AnalysisException:  # no such folder
        return False


def _bool(c: Column) -> Column:
    """NULL conditions hold for no row, as in the batch checks."""
    return F.coalesce(c, F.lit(False))


def write_batch(bronze: DataFrame, table: str, batch: str, checks: list[RowCheck] | None = None) -> bool:
    """Write and commit ``bronze`` as batch ``batch``; False if it was committed before."""
    spark, checks = bronze.sparkSession, checks or []
    if _is_committed(spark, table, batch):
        return False
    seen = Observation(f"bronze-{uuid.uuid4().hex}")
    counts = [F.count_if(_bool(c.violated)).alias(f"v{k}") for k, c in enumerate(checks)]
    rows = bronze.observe(seen, F.count(F.lit(1)).alias("rows_in"), *counts)
    for c in checks:
        if c.severity == "drop":
            rows = rows.filter(~_bool(c.violated))
    # which rows go is decided above the observation, so that all are counted
    write_bronze_batch(rows, f"{table}/data/batch={batch}", mode="overwrite")
    found = _observed(seen, checks)
    violations = {c.name: found[f"v{k}"] for k, c in enumerate(checks)}
    bad = {c.name: violations[c.name] for c in checks if c.severity == "error" and violations[c.name]}
    if bad:
        raise BatchRefused(f"batch {batch}: {bad}")
    _commit(spark, table, batch, found["rows_in"], violations)
    return True


def _observed(seen: Observation, checks: list[RowCheck]) -> dict[str, int]:
    """What was counted; a batch known to be empty is planned without the observation, so nothing was."""
    try:
        return seen.get
    except Py4JJavaError:
        return {"rows_in": 0, **{f"v{k}": 0 for k in range(len(checks))}}


def _commit(spark: SparkSession, table: str, batch: str, rows_in: int, violations: dict[str, int], replaced: list[str] | None = None) -> None:
    """The manifest of a written batch: a row per day, or one without a day if nothing was written."""
    try:
        days = spark.read.schema(BRONZE).option("basePath", f"{table}/data/batch={batch}").parquet(f"{table}/data/batch={batch}")
    except AnalysisException:
        days = spark.createDataFrame([], BRONZE)
    days = stored_table(days.groupBy("dt").agg(F.count(F.lit(1)).alias("row_count")), "days")
    if not replaced and not rows_in and not days.isEmpty():
        raise RuntimeError(f"batch {batch} has rows, but none were observed")
    head = spark.range(1).select(F.lit(None).cast("string").alias("dt"), F.lit(0).cast("bigint").alias("row_count"))
    pairs = [x for item in violations.items() for x in (F.lit(item[0]), F.lit(item[1]).cast("bigint"))]
    entry = days.unionByName(head).select(
        F.lit(batch).alias("batch"), "dt", "row_count", F.lit(rows_in).cast("bigint").alias("rows_in"),
        (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string, bigint>").alias("violations"),
        F.array(*[F.lit(r) for r in replaced or []]).cast("array<string>").alias("replaced"), F.current_timestamp().alias("committed_at"))
    # one file, renamed into place when it is complete
    entry.coalesce(1).write.mode("overwrite").parquet(_manifest_path(table, batch))


def manifest(spark: SparkSession, table: str) -> DataFrame:
    """Every committed entry; empty if there is none."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{table}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def live_days(spark: SparkSession, table: str, dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """``batch, dt, row_count`` of what the table consists of now: committed and not replaced."""
    log = manifest(spark, table)
    gone = log.select("dt", F.explode("replaced").alias("batch")).distinct()
    days = log.filter(F.col("dt").isNotNull()).select("batch", "dt", "row_count")
    if dt_from:
        days = days.filter(F.col("dt") >= dt_from)
    if dt_to:
        days = days.filter(F.col("dt") <= dt_to)
    return days.join(gone, ["batch", "dt"], "left_anti")


def violations(spark: SparkSession, table: str) -> DataFrame:
    """``check_name, failures`` over all batches of the streams, as counted while they were written."""
    each = manifest(spark, table).filter(F.col("dt").isNull()).select(F.explode("violations").alias("check_name", "failures"))
    return each.groupBy("check_name").agg(F.sum("failures").alias("failures"))


def _rows(spark: SparkSession, table: str, live: DataFrame) -> DataFrame:
    """The rows of the (batch, dt) in ``live``."""
    named = live.select("batch", "dt").limit(MAX_PATHS + 1).collect()
    if not named:
        return spark.createDataFrame([], BRONZE).select(*BRONZE_COLUMNS)
    files = spark.read.schema(T.StructType([*BRONZE.fields, T.StructField("batch", T.StringType())])).option("basePath", f"{table}/data")
    if len(named) <= MAX_PATHS:
        rows = files.parquet(*[f"{table}/data/batch={r.batch}/dt={r.dt}" for r in named])
    else:
        rows = files.parquet(f"{table}/data").join(live.select("batch", "dt"), ["batch", "dt"], "left_semi")
    return rows.select(*BRONZE_COLUMNS)


def read_bronze_table(spark: SparkSession, table: str, dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """The rows of the committed batches, each once; only the folders of the days asked for are listed."""
    ensure_conf(spark)
    return _rows(spark, table, live_days(spark, table, dt_from, dt_to))


def compact_days(spark: SparkSession, table: str, dt_from: str, dt_to: str) -> str | None:
    """Rewrite the live rows of the days ``[dt_from, dt_to]`` into one folder; the entry that replaces the old ones is written last.

    Batches that are committed meanwhile stay live beside it.
    """
    ensure_conf(spark)
    old = stored_table(live_days(spark, table, dt_from, dt_to), "compacted")
    batches = [r.batch for r in old.select("batch").distinct().collect()]
    if not batches:
        return None
    batch = f"days-{uuid.uuid4().hex}"
    write_bronze_batch(_rows(spark, table, old), f"{table}/data/batch={batch}", mode="overwrite")
    _commit(spark, table, batch, 0, {}, batches)
    return batch


def start_bronze_table(records: DataFrame, table: str, checkpoint: str, trigger_seconds: int = 120, available_now: bool = False,
                       checks: list[RowCheck] | None = None):
    """Records (Kafka-shaped, a stream) into the bronze table, each once."""
    ensure_conf(records.sparkSession)

    def each(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        # foreachBatch runs ordinary queries, so the stream's ban on adaptive plans doesn't concern them
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(to_bronze(batch), table, f"{query}-{batch_id:010d}", checks)

    w = records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()
