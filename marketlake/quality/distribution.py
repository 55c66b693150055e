"""Distributional checks (Q58-Q60)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.quality.engines import where

__all__ = ["values_to_be_within_n_stdevs", "values_to_be_within_n_moving_stdevs",
           "row_values_to_have_data_for_every_n_datepart"]


def values_to_be_within_n_stdevs(df, column, group_by=None, sigma_threshold=3):
    """Q58: groups whose summed value is more than ``sigma_threshold``
    standard deviations from the mean of all group sums.

    The whole-table mean/stddev is a one-row aggregate joined back (a 1-row
    broadcast), not an unpartitioned window.  Without ``group_by`` there is
    a single sum, its stddev is NULL and the check always passes.
    """
    sums = df.groupBy(*(group_by or [])).agg(F.sum(column).alias(column))
    stats = sums.agg(F.avg(column).alias(f"{column}_average"), F.stddev_samp(column).alias(f"{column}_stddev"))
    z = sums.crossJoin(F.broadcast(stats)).withColumn(
        f"{column}_sigma", (F.col(column) - F.col(f"{column}_average")) / F.nullif(F.col(f"{column}_stddev"), F.lit(0)))
    return z.filter(F.abs(F.col(f"{column}_sigma")) > sigma_threshold)


def _metric(x, take_logs):
    return F.coalesce(F.ln(F.nullif(x, F.lit(0))), F.lit(0)) if take_logs else F.coalesce(x, F.lit(0))


def values_to_be_within_n_moving_stdevs(df, column, date_column, group_by=None, period="day",
                                        lookback_periods=1, trend_periods=7, test_periods=14,
                                        sigma_threshold=3, sigma_threshold_upper=None,
                                        sigma_threshold_lower=None, take_diffs=True, take_logs=True,
                                        now=None):
    """Q59: per-period sums, optional log and lagged difference, then a
    z-score against the trailing ``trend_periods`` (excluding the current
    period).  Only the last ``test_periods`` complete periods before ``now``
    are tested; a NULL sigma passes.

    Windows run on one row per (group, period), so their size is bounded by
    the number of periods, not by the table.
    """
    upper = sigma_threshold_upper if sigma_threshold_upper else sigma_threshold
    lower = sigma_threshold_lower if sigma_threshold_lower else -1 * sigma_threshold
    group_by = list(group_by or [])
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    g = df.groupBy(F.date_trunc(period, date_column).alias("metric_period"), *group_by) \
        .agg(F.sum(column).alias("agg_metric_value"))
    w = Window.partitionBy(*group_by).orderBy("metric_period")
    if take_diffs:
        g = g.withColumn("prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(w))
        g = g.withColumn("metric_test_value", _metric(F.col("agg_metric_value"), take_logs)
                         - _metric(F.col("prior_agg_metric_value"), take_logs))
    else:
        g = g.withColumn("metric_test_value", _metric(F.col("agg_metric_value"), take_logs))
    trail = w.rowsBetween(-trend_periods, -1)
    g = (g.withColumn("metric_test_rolling_average", F.avg("metric_test_value").over(trail))
         .withColumn("metric_test_rolling_stddev", F.stddev_samp("metric_test_value").over(trail)))
    g = (g.withColumn("metric_test_delta", F.col("metric_test_value") - F.col("metric_test_rolling_average"))
         .withColumn("metric_test_sigma", F.col("metric_test_delta")
                     / F.nullif(F.col("metric_test_rolling_stddev"), F.lit(0))))
    cur = F.date_trunc(period, now_c)
    lo = F.expr(f"date_trunc('{period}', {_now_sql(now)}) - interval {test_periods} {period}")
    return g.filter((F.col("metric_period") >= lo) & (F.col("metric_period") < cur)
                    & ~((F.col("metric_test_sigma") >= lower) & (F.col("metric_test_sigma") <= upper)))


def _now_sql(now):
    return f"timestamp'{now}'" if now is not None else "current_timestamp()"


SPINE_STEP = {"minute": "1 minute", "hour": "1 hour", "day": "1 day", "week": "7 days", "month": "1 month",
              "quarter": "3 months", "year": "1 year"}


def row_values_to_have_data_for_every_n_datepart(df, date_col, date_part="day", interval=None,
                                                 row_condition=None, exclusion_condition=None,
                                                 test_start_date=None, test_end_date=None):
    """Q60: spine buckets (``date_part`` steps, every ``interval``) with no rows.

    Start/end default to the data's min/max date, computed inside the plan
    (one tiny aggregate), and the spine is ``sequence`` + ``explode`` of that
    one row: end-exclusive, so the last date is never checked.  Rows are
    counted per bucket with partial aggregation, and the spine is
    left-joined to those counts.
    """
    base = where(df, row_condition)
    bounds = base.agg(F.min(F.col(date_col).cast("date")).alias("_lo"),
                      F.max(F.col(date_col).cast("date")).alias("_hi"))
    lo = F.lit(test_start_date).cast("date") if test_start_date else F.col("_lo")
    hi = F.lit(test_end_date).cast("date") if test_end_date else F.col("_hi")
    bounds = bounds.select(lo.alias("_lo"), hi.alias("_hi"))
    if date_part not in SPINE_STEP:
        raise ValueError(f"date_part must be one of {sorted(SPINE_STEP)}")
    step = F.expr(f"interval {SPINE_STEP[date_part]}")
    dp = f"date_{date_part}"
    spine = bounds.filter(F.col("_hi") > F.col("_lo")).select(
        "_lo", F.explode(F.sequence(F.date_trunc(date_part, F.col("_lo")),
                                    F.date_trunc(date_part, F.col("_hi")) - step, step)).alias(dp))
    spine = spine.select("_lo", F.col(dp).cast("timestamp").alias(dp))
    if interval:
        spine = spine.filter(_periods_between(F.col("_lo"), F.col(dp), date_part) % interval == 0)
        data_key = F.date_trunc(date_part, F.col(date_col)).cast("timestamp")
        off = _periods_between(F.col("_lo"), F.col(date_col), date_part) % interval
        data_key = _add_periods(data_key, -off, date_part)
        counts = base.crossJoin(F.broadcast(bounds.select("_lo"))).groupBy(data_key.alias(dp)) \
            .agg(F.count(F.lit(1)).alias("row_cnt"))
    else:
        counts = base.groupBy(F.date_trunc(date_part, F.col(date_col)).cast("timestamp").alias(dp)) \
            .agg(F.count(F.lit(1)).alias("row_cnt"))
    final = spine.drop("_lo").join(counts, dp, "left").select(
        dp, F.col("row_cnt").isNull().alias("is_missing"), F.coalesce("row_cnt", F.lit(0)).alias("row_cnt"))
    out = final.filter(F.col("row_cnt") == 0)
    return out.filter(F.expr(exclusion_condition)) if exclusion_condition else out


def _periods_between(start, end, date_part):
    s, e = start.cast("date"), end.cast("date")
    if date_part in ("hour", "minute"):
        seconds = F.unix_timestamp(F.date_trunc(date_part, end)) - F.unix_timestamp(F.date_trunc(date_part, start))
        return F.floor(seconds / (3600 if date_part == "hour" else 60))
    if date_part == "day":
        return F.datediff(e, s)
    if date_part == "week":
        return F.floor(F.datediff(F.date_trunc("week", e).cast("date"), F.date_trunc("week", s).cast("date")) / 7)
    if date_part == "quarter":
        return (F.year(e) - F.year(s)) * 4 + F.quarter(e) - F.quarter(s)
    if date_part == "year":
        return F.year(e) - F.year(s)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def _add_periods(ts, n, date_part):
    return F.timestamp_add(date_part.upper(), n, ts)
