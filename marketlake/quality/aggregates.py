"""Aggregate checks (Q41-Q51).  Each aggregates per group with partial
(map-side) aggregation and returns the failing groups with ``metric``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.quality.engines import equal_expression, metric_between, where
from marketlake.session import stored_table

__all__ = ["distinct_count_to_equal", "distinct_count_to_be_greater_than", "distinct_count_to_be_less_than",
           "distinct_count_to_equal_other_table", "distinct_values_to_be_in_set",
           "distinct_values_to_contain_set", "distinct_values_to_equal_set", "max_to_be_between",
           "min_to_be_between", "mean_to_be_between", "median_to_be_between", "sum_to_be_between",
           "stdev_to_be_between", "unique_value_count_to_be_between", "quantile_values_to_be_between",
           "proportion_of_unique_values_to_be_between", "most_common_value_to_be_in_set",
           "most_common_values"]


def _metric_check(df, metric, pred, group_by, row_condition):
    agg = where(df, row_condition).groupBy(*(group_by or [])).agg(metric.alias("metric"))
    return agg.filter(~pred(F.col("metric")))


def distinct_count_to_equal(df, column, value, group_by=None, row_condition=None):
    """Q41."""
    return _metric_check(df, F.count_distinct(column), lambda m: m == value, group_by, row_condition)


def distinct_count_to_be_greater_than(df, column, value, group_by=None, row_condition=None):
    """Q42."""
    return _metric_check(df, F.count_distinct(column), lambda m: m > value, group_by, row_condition)


def distinct_count_to_be_less_than(df, column, value, group_by=None, row_condition=None):
    """Q43."""
    return _metric_check(df, F.count_distinct(column), lambda m: m < value, group_by, row_condition)


def distinct_count_to_equal_other_table(df, column, compare_df, compare_column=None, row_condition=None,
                                        compare_row_condition=None):
    """Q44."""
    return equal_expression(df, F.count_distinct(column), compare_df,
                            F.count_distinct(compare_column or column),
                            row_condition=row_condition, compare_row_condition=compare_row_condition)


def _set_df(spark, value_set, quote_values):
    vals = [str(v) for v in value_set] if quote_values else list(value_set)
    return spark.createDataFrame([(v,) for v in vals], "value_field string" if quote_values else None) \
        if quote_values else spark.createDataFrame([(v,) for v in vals], ["value_field"])


def distinct_values_to_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """Q45: distinct non-NULL values that are not in the set."""
    vals = [str(v) for v in value_set] if quote_values else list(value_set)
    c = F.col(column).cast("string") if quote_values else F.col(column)
    d = where(df, row_condition).select(c.alias("value_field")).filter("value_field IS NOT NULL").distinct()
    return d.filter(~F.col("value_field").isin(vals))


def distinct_values_to_contain_set(df, column, value_set, quote_values=True, row_condition=None):
    """Q46: set values that never occur in the column.

    The set is a literal list (small, given by the caller); the column side
    is reduced to its distinct values before the anti join.
    """
    spark = df.sparkSession
    s = _set_df(spark, value_set, quote_values).distinct()
    c = F.col(column).cast("string") if quote_values else F.col(column)
    d = where(df, row_condition).select(c.alias("value_field")).distinct()
    return s.join(d, "value_field", "left_anti")


def distinct_values_to_equal_set(df, column, value_set, quote_values=True, row_condition=None):
    """Q47: values in exactly one of (column, set): a full outer join of the
    distinct column values with the literal set."""
    spark = df.sparkSession
    s = _set_df(spark, value_set, quote_values).distinct().withColumn("_in_set", F.lit(True))
    c = F.col(column).cast("string") if quote_values else F.col(column)
    d = where(df, row_condition).select(c.alias("value_field")).distinct().withColumn("_in_col", F.lit(True))
    j = d.join(s, "value_field", "full_outer")
    return j.filter(F.col("_in_set").isNull() | F.col("_in_col").isNull()).select("value_field")


def max_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                      strictly=False):
    """Q48a."""
    return metric_between(df, F.max(column), min_value, max_value, group_by, row_condition, strictly)


def min_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                      strictly=False):
    """Q48b."""
    return metric_between(df, F.min(column), min_value, max_value, group_by, row_condition, strictly)


def mean_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                       strictly=False):
    """Q48c."""
    return metric_between(df, F.avg(column), min_value, max_value, group_by, row_condition, strictly)


def median_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                         strictly=False, exact=True):
    """Q48d: the median (one row per group), exact by default (see
    :func:`exact_quantiles`); ``exact=False`` uses ``percentile_approx``."""
    return quantile_values_to_be_between(df, column, 0.5, min_value, max_value, group_by, row_condition, strictly, exact)


def sum_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                      strictly=False):
    """Q48e."""
    return metric_between(df, F.sum(column), min_value, max_value, group_by, row_condition, strictly)


def stdev_to_be_between(df, column, min_value=None, max_value=None, group_by=None, row_condition=None,
                        strictly=False):
    """Q48f: sample standard deviation."""
    return metric_between(df, F.stddev_samp(column), min_value, max_value, group_by, row_condition, strictly)


def unique_value_count_to_be_between(df, column, min_value=None, max_value=None, group_by=None,
                                     row_condition=None, strictly=False):
    """Q48g."""
    return metric_between(df, F.count_distinct(column), min_value, max_value, group_by, row_condition,
                          strictly)


def quantile_values_to_be_between(df, column, quantile, min_value=None, max_value=None, group_by=None,
                                  row_condition=None, strictly=False, exact=True):
    """Q49: continuous (interpolated) quantile, or approximate."""
    if not exact:
        return metric_between(df, F.percentile_approx(column, quantile, 10000), min_value, max_value, group_by,
                              row_condition, strictly)
    metric = exact_quantiles(where(df, row_condition), column, quantile, group_by)
    return metric_between(metric, F.first("metric"), min_value, max_value, group_by, None, strictly)


def exact_quantiles(df, column, quantile, group_by=None):
    """``group_by, metric``: the interpolated quantile of every group, without
    a task that holds a group's values.

    Values are counted, the counts dealt to range partitions of (group,
    value), and running totals per partition say where the two ranks around
    the quantile lie.  The key-less or per-group window runs over one row per
    partition.
    """
    group_by = list(group_by or [])
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.filter(F.col(column).isNotNull()).groupBy(*group_by, F.col(column).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    dealt = stored_table(counts.repartitionByRange(n, *group_by, "_v").withColumn("_part", F.spark_partition_id()), "counts")
    parts = Window.partitionBy(*group_by)
    sums = dealt.groupBy(*group_by, "_part").agg(F.sum("_n").alias("_s"))
    sums = sums.select(
        *[F.col(c).alias(f"_g_{c}") for c in group_by], F.col("_part").alias("_of"),
        (F.sum("_s").over(parts.orderBy("_part")) - F.col("_s")).alias("_before"), F.sum("_s").over(parts).alias("_all"))
    match = F.col("_part") == F.col("_of")
    for c in group_by:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    upto = F.sum("_n").over(Window.partitionBy(*group_by, "_part").orderBy("_v")) + F.col("_before")
    ranked = dealt.join(sums, match).withColumn("_upto", upto).withColumn("_at", F.lit(float(quantile)) * (F.col("_all") - 1))
    holds = lambda r: (F.col("_upto") - F.col("_n") <= r) & (r < F.col("_upto"))
    value = F.col("_v").cast("double")
    found = ranked.groupBy(*group_by).agg(
        F.max(F.when(holds(F.floor("_at")), value)).alias("_lo"), F.max(F.when(holds(F.ceil("_at")), value)).alias("_hi"),
        F.first("_at").alias("_at"))
    share = F.col("_at") - F.floor("_at")
    return found.select(*group_by, (F.col("_lo") * (1 - share) + F.col("_hi") * share).alias("metric"))


def proportion_of_unique_values_to_be_between(df, column, min_value=None, max_value=None, group_by=None,
                                              row_condition=None, strictly=False):
    """Q50: count(distinct) / count(column)."""
    m = F.count_distinct(column) / F.count(column)
    return metric_between(df, m, min_value, max_value, group_by, row_condition, strictly)


#: Items that a sketch of frequent values tracks; candidates that are then counted exactly.
TRACKED, CANDIDATES = 1 << 14, 1 << 10
#: A value that a sketch of n rows does not report occurs at most UNSEEN * n / tracked times: its map has 4/3 of the tracked
#: items and is off by 3.5 * n / map, and values above twice that are reported (5.25, taken with a margin).
UNSEEN = 8


def most_common_values(df, column, top_n, tracked=TRACKED, candidates=CANDIDATES):
    """``value_field, value_count`` of the ``top_n`` most frequent values (NULL
    is one), equal counts by value; the counts are exact.

    A sketch of frequent values names candidates in one pass without a shuffle
    of the values, a second pass counts only these.  A value that is no
    candidate occurs at most ``unseen`` times: if the last rank's exact count
    is above that, no other value can have the rank, not by a tie either.
    Otherwise (flat distributions) every distinct value is counted.  Runs two
    jobs when called; at most ``candidates`` rows come to the driver.
    """
    top_n, candidates = int(top_n), min(int(candidates), int(tracked))
    if top_n < 1:
        raise ValueError("top_n must be positive")
    c = F.col(column)
    if dict(df.dtypes)[column] in ("float", "double"):
        c = c + F.lit(0.0).cast(dict(df.dtypes)[column])  # -0.0 is 0.0, as in groupBy
    values = df.select(c.alias("value_field"))
    order = [F.col("value_count").desc(), F.col("value_field").asc()]
    counted = lambda rows: rows.groupBy("value_field").agg(F.count(F.lit(1)).alias("value_count"))
    if top_n < candidates:
        seen = values.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(value_field, {candidates}, {int(tracked)})").alias("top")).first()
        unseen = seen.n * UNSEEN / tracked
        if len(seen.top) == candidates:  # there may be more of them, none estimated higher
            unseen = max(unseen, min(r["count"] for r in seen.top))
        named = df.sparkSession.createDataFrame([(r["item"],) for r in seen.top], values.schema)
        same = F.col("v.value_field").eqNullSafe(F.col("c.value_field"))
        exact = counted(values.alias("v").join(F.broadcast(named.alias("c")), same, "left_semi"))
        top = exact.orderBy(*order).limit(top_n).collect()
        if len(top) == top_n and top[-1].value_count > unseen:
            return df.sparkSession.createDataFrame(top, exact.schema)
    return counted(values).orderBy(*order).limit(top_n)


def most_common_value_to_be_in_set(df, column, value_set, top_n, quote_values=True, data_type="decimal",
                                   row_condition=None, candidates_first=False):
    """Q51: the value ranked exactly ``top_n`` by frequency, if not in the set.

    Counts are one row per distinct value (partial aggregation); the rank is
    a ``row_number`` over those counts.  Equal counts are ordered by value to
    make the rank deterministic (the SQL form leaves ties unspecified).
    ``candidates_first`` gives the same result by :func:`most_common_values`,
    which spares the shuffle of all distinct values where there are many.
    """
    c = F.col(column) if quote_values else F.col(column).cast(data_type)
    order = [F.col("value_count").desc(), F.col("value_field").asc()]
    rows = where(df, row_condition)
    if candidates_first:
        counts = most_common_values(rows.select(c.alias("value_field")), "value_field", top_n)
    else:
        counts = rows.groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("value_count"))
    # Only the first top_n ranks matter: a distributed top-k (each task keeps
    # its best top_n, then they are merged) bounds what is ranked together.
    ranked = counts.orderBy(*order).limit(top_n).withColumn(
        "value_count_rank", F.row_number().over(Window.orderBy(*order)))
    top = ranked.filter(F.col("value_count_rank") == top_n).select("value_field")
    vals = [str(v) for v in value_set] if quote_values else list(value_set)
    return top.filter(~F.col("value_field").isin(vals))
