"""Table-shape checks (Q5-Q19).

Schema checks only read ``df.schema`` (no job); row-count checks are
grouped counts with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.quality.engines import equal_expression, expression_is_true, metric_between, where

__all__ = ["column_to_exist", "row_values_to_have_recent_data", "grouped_row_values_to_have_recent_data",
           "table_aggregation_to_equal_other_table", "table_column_count_to_be_between",
           "table_column_count_to_equal", "table_column_count_to_equal_other_table",
           "table_columns_to_contain_set", "table_columns_to_not_contain_set", "table_columns_to_match_set",
           "table_columns_to_match_ordered_list", "table_row_count_to_be_between", "table_row_count_to_equal",
           "table_row_count_to_equal_other_table", "table_row_count_to_equal_other_table_times_factor"]


def _rows(df, rows, schema):
    return df.sparkSession.createDataFrame(rows, schema)


def _names(df, transform="upper"):
    f = str.upper if transform == "upper" else (str.lower if transform == "lower" else (lambda s: s))
    return [f(c) for c in df.columns], f


def column_to_exist(df, column_name, column_index=None, transform="upper"):
    """Q5: one violation row when the column is missing or not at the
    1-based ``column_index`` (index 0 or None is not checked)."""
    names, f = _names(df, transform)
    c = f(column_name)
    bad = c not in names or (column_index and (column_index > len(names) or names[column_index - 1] != c))
    return _rows(df, [(column_name, column_index)] if bad else [], "column_name string, column_index int")


def row_values_to_have_recent_data(df, column, datepart, interval, row_condition=None, now=None):
    """Q6: one row (max_timestamp) when the newest non-future value is older
    than ``now - interval datepart``; an empty table compares as 1970."""
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    ts = F.col(column).cast("timestamp")
    m = where(df, row_condition).filter(ts <= now_c).agg(F.max(ts).alias("max_timestamp"))
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now_c)
    return m.filter(F.coalesce("max_timestamp", F.lit("1970-01-01").cast("timestamp")) < limit)


def grouped_row_values_to_have_recent_data(df, group_by, timestamp_column, datepart, interval,
                                           row_condition=None, now=None):
    """Q7: groups whose newest non-future timestamp is too old.  Groups only
    exist where rows exist, so an empty table passes, and rows with a NULL
    key belong to no group (both as in the SQL form's equality join)."""
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    ts = F.col(timestamp_column).cast("timestamp")
    g = (where(df, row_condition).filter(ts <= now_c).dropna(subset=list(group_by)).groupBy(*group_by)
         .agg(F.max(ts).alias("latest_timestamp_column"), F.lit(1).alias("row_count")))
    limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now_c)
    return g.filter(F.col("latest_timestamp_column") < limit)


def table_aggregation_to_equal_other_table(df, expression, compare_df, compare_expression=None, group_by=None,
                                           compare_group_by=None, row_condition=None, compare_row_condition=None,
                                           tolerance=0.0, tolerance_percent=None):
    """Q8."""
    return equal_expression(df, expression, compare_df, compare_expression, group_by, compare_group_by,
                            row_condition, compare_row_condition, tolerance, tolerance_percent)


def table_column_count_to_be_between(df, min_value=None, max_value=None):
    """Q9: bounds of 0/None are ignored."""
    n = len(df.columns)
    bad = (bool(min_value) and n < min_value) or (bool(max_value) and n > max_value)
    return _rows(df, [(n,)] if bad else [], "column_count int")


def table_column_count_to_equal(df, value):
    """Q10."""
    n = len(df.columns)
    return _rows(df, [(n,)] if n != value else [], "column_count int")


def table_column_count_to_equal_other_table(df, compare_df):
    """Q11."""
    a, b = len(df.columns), len(compare_df.columns)
    return _rows(df, [(a, b)] if a != b else [], "column_count int, other_column_count int")


def table_columns_to_contain_set(df, column_list, transform="upper"):
    """Q12: listed columns that are missing."""
    names, f = _names(df, transform)
    return _rows(df, [(c,) for c in column_list if f(c) not in names], "column_name string")


def table_columns_to_not_contain_set(df, column_list, transform="upper"):
    """Q13: listed columns that are present."""
    names, f = _names(df, transform)
    return _rows(df, [(c,) for c in column_list if f(c) in names], "column_name string")


def table_columns_to_match_set(df, column_list, transform="upper"):
    """Q14: names in exactly one of (table, list)."""
    names, f = _names(df, transform)
    want = [f(c) for c in column_list]
    rows = [(n, None) for n in names if n not in want] + [(None, w) for w in want if w not in names]
    return _rows(df, rows, "relation_column string, input_column string")


def table_columns_to_match_ordered_list(df, column_list, transform="upper"):
    """Q15: positions where the table and the list differ."""
    names, f = _names(df, transform)
    want = [f(c) for c in column_list]
    rows = []
    for i in range(max(len(names), len(want))):
        a = names[i] if i < len(names) else None
        b = want[i] if i < len(want) else None
        if a != b:
            rows.append((a, i + 1 if a else None, b, i + 1 if b else None))
    return _rows(df, rows, "relation_column string, relation_column_idx int, input_column string, "
                           "input_column_idx int")


def table_row_count_to_be_between(df, min_value=None, max_value=None, group_by=None, row_condition=None,
                                  strictly=False):
    """Q16."""
    return metric_between(df, F.count(F.lit(1)), min_value, max_value, group_by, row_condition, strictly)


def table_row_count_to_equal(df, value, group_by=None, row_condition=None):
    """Q17."""
    return expression_is_true(df, F.count(F.lit(1)) == F.lit(value), group_by=group_by,
                              row_condition=row_condition, aggregate=True)


def table_row_count_to_equal_other_table(df, compare_df, group_by=None, compare_group_by=None, factor=1,
                                         row_condition=None, compare_row_condition=None):
    """Q18."""
    return equal_expression(df, F.count(F.lit(1)), compare_df, F.count(F.lit(1)) * factor, group_by,
                            compare_group_by, row_condition, compare_row_condition)


def table_row_count_to_equal_other_table_times_factor(df, compare_df, factor, group_by=None,
                                                      compare_group_by=None, row_condition=None,
                                                      compare_row_condition=None):
    """Q19."""
    return table_row_count_to_equal_other_table(df, compare_df, group_by, compare_group_by, factor,
                                                row_condition, compare_row_condition)
