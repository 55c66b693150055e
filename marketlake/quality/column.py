"""Column-value checks (Q20-Q30)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.ordered import lag_in_order
from marketlake.quality.engines import expression_between, row_violations, where

__all__ = ["values_to_be_between", "values_to_be_increasing", "values_to_be_decreasing",
           "values_to_be_in_set", "values_to_not_be_in_set", "values_to_be_in_type_list",
           "values_to_be_of_type", "values_to_be_null", "values_to_not_be_null", "values_to_be_unique",
           "values_to_have_consistent_casing", "type_name"]


def values_to_be_between(df, column, min_value=None, max_value=None, row_condition=None, strictly=False):
    """Q20: rows outside [min, max] (NULLs pass)."""
    return expression_between(df, F.col(column), min_value, max_value, row_condition=row_condition,
                              strictly=strictly)


def _monotonic(df, column, sort_column, strictly, row_condition, group_by, increasing):
    base = where(df, row_condition)
    sort_column = sort_column or column
    with_prev = lag_in_order(base, column, sort_column, group_by, out="previous_value")
    cur, prev = F.col(column), F.col("previous_value")
    if increasing:
        ok = (cur > prev) if strictly else (cur >= prev)
    else:
        ok = (cur < prev) if strictly else (cur <= prev)
    return with_prev.filter(prev.isNotNull() & ~ok)


def values_to_be_increasing(df, column, sort_column=None, strictly=True, row_condition=None, group_by=None):
    """Q21: rows whose value is not above (or, non-strict, below) the previous
    row's in ``sort_column`` order; output keeps ``previous_value``."""
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, True)


def values_to_be_decreasing(df, column, sort_column=None, strictly=True, row_condition=None, group_by=None):
    """Q22: mirror of Q21."""
    return _monotonic(df, column, sort_column, strictly, row_condition, group_by, False)


def values_to_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """Q23: rows whose value is not in the set; NULL is a violation.

    The set is a literal list, so this is a row-local ``IN`` (the anti-join
    of the SQL form without any exchange)."""
    vals = [str(v) for v in value_set] if quote_values else list(value_set)
    c = F.col(column)
    return row_violations(df, ~F.coalesce(c.isin(vals), F.lit(False)), row_condition)


def values_to_not_be_in_set(df, column, value_set, quote_values=True, row_condition=None):
    """Q24: rows whose value is in the forbidden set; NULL passes."""
    vals = [str(v) for v in value_set] if quote_values else list(value_set)
    return row_violations(df, F.coalesce(F.col(column).isin(vals), F.lit(False)), row_condition)


def type_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def values_to_be_in_type_list(df, column, column_type_list):
    """Q25: one row (column, type) when the column's type is not listed."""
    t = type_name(df, column)
    allowed = {x.lower() for x in column_type_list}
    spark = df.sparkSession
    rows = [] if t.lower() in allowed else [(column, t)]
    return spark.createDataFrame(rows, "column_name string, column_type string")


def values_to_be_of_type(df, column, column_type):
    """Q26."""
    return values_to_be_in_type_list(df, column, [column_type])


def values_to_be_null(df, column, row_condition=None):
    """Q27: rows where the column is not NULL."""
    return row_violations(df, F.col(column).isNotNull(), row_condition)


def values_to_not_be_null(df, column, row_condition=None):
    """Q28: rows where the column is NULL."""
    return row_violations(df, F.col(column).isNull(), row_condition)


def values_to_be_unique(df, column, row_condition=None):
    """Q29: duplicated non-NULL values with their count."""
    from marketlake.quality.multi import compound_columns_to_be_unique
    return compound_columns_to_be_unique(df, [column], ignore_row_if="any_value_is_missing",
                                         row_condition=row_condition)


def values_to_have_consistent_casing(df, column, display_inconsistent_columns=False):
    """Q30: values that occur in more than one letter case.

    Compact form returns one row (set_count, set_count_case_insensitive) when
    they differ; NULL counts in ``set_count`` but not in the case-insensitive
    distinct count, so a NULL makes the compact form fail (as in SQL).
    """
    d = df.select(F.col(column).alias("distinct_values")).distinct()
    if display_inconsistent_columns:
        return (d.groupBy(F.lower("distinct_values").alias("inconsistent_columns"))
                .agg(F.count("distinct_values").alias("set_count_case_insensitive"))
                .filter("set_count_case_insensitive > 1"))
    return (d.agg(F.count(F.lit(1)).alias("set_count"),
                  F.count_distinct(F.lower("distinct_values")).alias("set_count_case_insensitive"))
            .filter("set_count != set_count_case_insensitive"))
