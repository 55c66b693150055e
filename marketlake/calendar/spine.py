"""Series and date spines.

A spine is one row (start, end) exploded with ``sequence``: the row count is
the length of the calendar range, independent of the data volume, and the
bounds may come from the data itself (an aggregate in the same plan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Numbers that one row of a series unfolds to.
BLOCK = 1 << 16


def generate_series(bounds: DataFrame | SparkSession, upper_bound=None) -> DataFrame:
    """``generated_number`` = 1..N.  ``bounds`` is a one-row DataFrame
    with column ``upper_bound`` (or a session plus an int).

    The bound is known only when the plan runs, so the row is first unfolded
    to block numbers, which are dealt over the tasks in turn; each block is
    then a short sequence of its own."""
    if isinstance(bounds, SparkSession):
        if upper_bound is None or int(upper_bound) <= 0:
            raise ValueError("upper_bound must be positive")
        return bounds.range(1, int(upper_bound) + 1).withColumnRenamed("id", "generated_number")
    ub = F.col("upper_bound")
    checked = F.when(ub > 0, ub).otherwise(F.raise_error(F.lit("upper_bound must be positive")))
    tasks = int(bounds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.floor((checked.cast("bigint") - 1) / BLOCK).cast("bigint")
    blocks = bounds.select(checked.cast("bigint").alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("__b"))
    dealt = blocks.repartitionById(tasks, F.pmod("__b", F.lit(tasks)).cast("int"))
    first = F.col("__b") * BLOCK
    return dealt.select(F.explode(F.sequence(first + 1, F.least("__n", first + BLOCK))).alias("generated_number"))


def _boundaries(start: Column, end: Column, datepart: str) -> Column:
    """How many starts of a ``datepart`` lie in (start, end]."""
    if datepart in ("hour", "minute"):
        seconds = F.unix_timestamp(F.date_trunc(datepart, end)) - F.unix_timestamp(F.date_trunc(datepart, start))
        return F.floor(seconds / (3600 if datepart == "hour" else 60)).cast("int")
    days = F.datediff(end.cast("date"), start.cast("date"))
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    quarters = (F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)
    weeks = F.datediff(F.trunc(F.date_add(end.cast("date"), 1), "week"),
                       F.trunc(F.date_add(start.cast("date"), 1), "week")) / 7  # weeks start on Sunday
    return {"day": days, "month": months, "quarter": quarters, "year": F.year(end) - F.year(start),
            "week": weeks.cast("int")}[datepart]


def date_spine(bounds: DataFrame, datepart: str = "day", start: str = "start_date",
               end: str = "end_date") -> DataFrame:
    """``date_<datepart>``: ``start + k * step`` for k = 0, 1, ..., one for
    each ``datepart`` boundary between start and end, and none after end.

    With start and end on boundaries that is every period of [start, end);
    from 15 January to 10 March, by month, it is 15 January and 15 February.
    ``bounds`` holds one row per spine (more rows = several spines, e.g. one
    per series).  Steps are calendar intervals counted from start, so
    month ends do not drift.
    """
    s, e = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    n = _boundaries(s, e, datepart)
    # an empty range (end <= start) yields no rows, never an error
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    keep = [c for c in bounds.columns if c not in (start, end)]
    name = f"date_{datepart}"
    spine = bounds.select(*keep, s.alias("__s"), e.alias("__e"), F.explode(steps).alias("__k"))
    at = F.timestamp_add(datepart.upper(), F.col("__k"), F.col("__s"))
    return spine.withColumn(name, at).filter(F.col(name) <= F.col("__e")).select(*keep, name)


def base_dates(bounds: DataFrame | None = None, start_date=None, end_date=None, n_dateparts: int | None = None,
               datepart: str = "day", now=None, spark: SparkSession | None = None, tz: str | None = None) -> DataFrame:
    """D3: an explicit [start, end) range, or from ``n_dateparts`` before
    today up to and including today (``tz`` decides what today is)."""
    if bounds is None:
        spark = spark or SparkSession.getActiveSession()
        if n_dateparts is not None:
            from marketlake.calendar.functions import today
            day = today(now, tz).cast("timestamp")
            bounds = spark.range(1).select(
                F.timestamp_add(datepart.upper(), F.lit(-int(n_dateparts)), day).alias("start_date"),
                F.timestamp_add("DAY", F.lit(1), day).alias("end_date"))
        else:
            bounds = spark.range(1).select(F.lit(start_date).alias("start_date"), F.lit(end_date).alias("end_date"))
    return date_spine(bounds, datepart)
