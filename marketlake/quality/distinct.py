"""Q41-Q44, Q48g, Q50: distinct counts from sketches per day.

``refresh_sketches`` keeps one HyperLogLog sketch per day and column of a table that is stored by day. A day is read again only if its
files (names, sizes, times) are not those that its sketches were made from. ``distinct_counts`` merges the days. A check compares its bound
with the estimate's interval; only if the bound lies inside is the exact count taken from the table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import ensure_conf, stored_table

__all__ = ["refresh_sketches", "distinct_counts", "distinct_count_holds", "distinct_ratio_holds", "LG_K", "interval"]

#: 2 ** LG_K registers of a sketch: a standard error of 0.81 % (1.04 / sqrt(2 ** 14)); small counts are exact in it.
LG_K = 14
#: Standard errors to both sides that an estimate may be off; beyond them lies one case in 1.7 million.
SIGMAS, EXACT = 5, 8
STORED = "column_name string, sketch binary, row_count bigint, fingerprint bigint"
OPS = {"=": lambda lo, hi, v: (lo == hi == v, v < lo or v > hi), ">": lambda lo, hi, v: (lo > v, hi <= v), "<": lambda lo, hi, v: (hi < v, lo >= v),
       ">=": lambda lo, hi, v: (lo >= v, hi < v), "<=": lambda lo, hi, v: (hi <= v, lo > v)}


def interval(estimate: int, lg_k: int = LG_K) -> tuple[int, int]:
    """The counts that an estimate stands for.  A sketch keeps its first values as 26-bit hashes: for up to EXACT of them a collision is as
    unlikely as an error of SIGMAS."""
    if estimate <= EXACT:
        return estimate, estimate
    off = SIGMAS * 1.04 / 2 ** (lg_k / 2)
    return int(estimate / (1 + off)), int(estimate / (1 - off)) + 1


def _fingerprints(spark: SparkSession, table: str, day: str) -> DataFrame:
    """``day, fingerprint`` from a listing of the files; nothing in them is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(table)
    dated = files.select(F.regexp_extract("path", f"/{day}=([^/]*)/", 1).alias("day"), F.struct("path", "length", "modificationTime").alias("file"))
    return dated.groupBy("day").agg(F.xxhash64(F.sort_array(F.collect_list("file"))).alias("fingerprint"))


def _stored(spark: SparkSession, sketches: str) -> DataFrame:
    try:
        return spark.read.schema(f"{STORED}, day string").option("basePath", sketches).parquet(sketches)
    except AnalysisException:  # none yet
        return spark.createDataFrame([], f"{STORED}, day string")


def refresh_sketches(spark: SparkSession, table: str, sketches: str, columns: list[str], day: str = "dt", lg_k: int = LG_K) -> list[str]:
    """Bring the sketches of the Parquet ``table`` (directories by ``day``) up to date; the days that were read."""
    ensure_conf(spark)
    now, have = _fingerprints(spark, table, day), _stored(spark, sketches)
    # a day is written with all columns that any refresh has asked for
    columns = sorted({*columns, *(r.column_name for r in have.select("column_name").distinct().collect())})
    # a day whose files are gone keeps no sketches: it is not read by distinct_counts, as its fingerprint is not there any more
    known = have.groupBy("day", "fingerprint").agg(F.collect_set("column_name").alias("has"))
    complete = known.filter(F.size(F.array_except(F.array(*[F.lit(c) for c in columns]), "has")) == 0)
    changed = sorted(r.day for r in now.join(complete, ["day", "fingerprint"], "left_anti").collect())
    if not changed:
        return []
    marks = stored_table(now.filter(F.col("day").isin(changed)), "fingerprints")
    rows = spark.read.parquet(table).filter(F.col(day).isin(changed)).select(F.col(day).alias("day"), *columns)
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns]))
    each = rows.select("day", values.alias("x")).groupBy("day", "x.column_name").agg(
        F.hll_sketch_agg(F.col("x.v"), F.lit(lg_k)).alias("sketch"), F.count("x.v").alias("row_count"))
    # the listing may have changed meanwhile; then the day is found changed again and read once more
    each = each.join(marks, "day").select("column_name", "sketch", "row_count", "fingerprint", "day")
    each.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(sketches)
    return changed


def distinct_counts(spark: SparkSession, table: str, sketches: str, day: str = "dt", dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """``column_name, estimate, row_count`` (not NULL) over the days that the table has."""
    d = _stored(spark, sketches).join(_fingerprints(spark, table, day), ["day", "fingerprint"], "left_semi")
    if dt_from:
        d = d.filter(F.col("day") >= dt_from)
    if dt_to:
        d = d.filter(F.col("day") <= dt_to)
    return d.groupBy("column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"), F.sum("row_count").alias("row_count"))


def _exact(spark: SparkSession, table: str, column: str, day: str, dt_from: str | None, dt_to: str | None) -> int:
    rows = spark.read.parquet(table)
    if dt_from:
        rows = rows.filter(F.col(day) >= dt_from)
    if dt_to:
        rows = rows.filter(F.col(day) <= dt_to)
    return rows.agg(F.count_distinct(F.col(column).cast("string")).alias("n")).first()["n"]


def distinct_count_holds(spark: SparkSession, table: str, sketches: str, checks: list[tuple[str, str, float]], day: str = "dt",
                         dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """Q41-Q44, Q48g: ``column_name, op, value, holds, counted`` for each (column, op, value); ``counted`` tells where the exact count was needed."""
    found = {r.column_name: r.estimate for r in distinct_counts(spark, table, sketches, day, dt_from, dt_to).collect()}
    exact: dict[str, int] = {}
    out = []
    for column, op, value in checks:
        low, high = interval(found.get(column, 0)) if column not in exact else (exact[column],) * 2
        yes, no = OPS[op](low, high, value)
        if not yes and not no:
            exact[column] = _exact(spark, table, column, day, dt_from, dt_to)
            yes, _ = OPS[op](exact[column], exact[column], value)
        out.append((column, op, float(value), yes, column in exact))
    return spark.createDataFrame(out, "column_name string, op string, value double, holds boolean, counted boolean")


def distinct_ratio_holds(spark: SparkSession, table: str, sketches: str, checks: list[tuple[str, str, float]], day: str = "dt",
                         dt_from: str | None = None, dt_to: str | None = None) -> DataFrame:
    """Q50: the same for distinct values as a part of all that are not NULL; a column without values holds nothing."""
    rows = {r.column_name: r.row_count for r in distinct_counts(spark, table, sketches, day, dt_from, dt_to).collect()}
    scaled = [(c, op, value * rows.get(c, 0)) for c, op, value in checks]
    held = distinct_count_holds(spark, table, sketches, scaled, day, dt_from, dt_to).collect()
    out = [(c, op, float(v), h.holds and bool(rows.get(c)), h.counted) for (c, op, v), h in zip(checks, held, strict=True)]
    return spark.createDataFrame(out, "column_name string, op string, value double, holds boolean, counted boolean")
