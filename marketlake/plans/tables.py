"""The pipeline's tables, written once per source folder and bucket and then read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.plans.gold import read_gold
from marketlake.plans.pipeline import Layout, build_all, events_bronze
from marketlake.session import ensure_conf, scratch_path
from marketlake.sources.bronze import read_bronze
from marketlake.sources.silver import read_silver

_BUILT: dict[tuple[str, str, str, int], dict[str, str]] = {}


def _files_of(spark: SparkSession, path: str) -> int:
    """A hash of the names, sizes and times of the files; nothing in them is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()[0]


def built_paths(spark: SparkSession, sf_dir: str, bucket: str = "minute") -> dict[str, str]:
    """Paths of the tables that ``build_all`` wrote from ``events`` in this
    application; written again once the files of ``events`` are others."""
    key = (spark.sparkContext.applicationId, sf_dir, bucket, _files_of(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _BUILT:
        _BUILT[key] = build_all(spark, events_bronze(spark, sf_dir), Layout(scratch_path(spark, "tables")), bucket)
    return _BUILT[key]


def events_gold(spark: SparkSession, sf_dir: str, bucket: str = "minute") -> DataFrame:
    """The stored gold mart; a filter on its days prunes directories."""
    ensure_conf(spark)
    return read_gold(spark, built_paths(spark, sf_dir, bucket)["fct_market_metrics"])


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, built_paths(spark, sf_dir)["bronze"])


def pipeline_tables(spark: SparkSession, sf_dir: str, bucket: str = "hour") -> dict[str, DataFrame]:
    """Every model of the project, as stored."""
    paths = built_paths(spark, sf_dir, bucket)
    out = {n: spark.read.parquet(p) for n, p in paths.items() if n.startswith("int_")}
    out |= {n: read_silver(spark, paths[n]) for n in ("stg_trades", "stg_depth")}
    return out | {"bronze": read_bronze(spark, paths["bronze"]), "fct_market_metrics": events_gold(spark, sf_dir, bucket)}
