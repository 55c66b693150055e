"""Multi-column checks (Q52-Q57)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.quality.engines import as_col, ignore_row_if as keep_row, row_violations, tag_unique_check, where

__all__ = ["compound_columns_to_be_unique", "select_column_values_to_be_unique_within_record",
           "multicolumn_sum_to_equal", "column_pair_values_A_to_be_greater_than_B",
           "column_pair_values_to_be_equal", "column_pair_values_to_be_in_set"]


def compound_columns_to_be_unique(df, column_list, ignore_row_if_mode="all_values_are_missing",
                                  row_condition=None, ignore_row_if=None):
    """Q52: duplicated combinations with ``n_records``.

    A plain grouped count: partial counts are combined map-side, so a hot
    combination costs one row per map task in the shuffle.
    """
    mode = ignore_row_if or ignore_row_if_mode
    keep = keep_row(column_list, mode)
    found = (where(df, row_condition).filter(keep).groupBy(*column_list).agg(F.count(F.lit(1)).alias("n_records"))
             .filter("n_records > 1"))
    return tag_unique_check(found, df, column_list, keep if row_condition is None else F.when(as_col(row_condition), keep))


def select_column_values_to_be_unique_within_record(df, column_list, ignore_row_if_mode="all_values_are_missing",
                                                    row_condition=None, ignore_row_if=None):
    """Q53: rows with fewer distinct non-NULL values than listed columns, so
    a repeated value and a NULL both violate.

    Row-local: ``size(array_distinct(array_compact(array(cols))))`` against
    the number of columns; no shuffle, no global sort.
    """
    mode = ignore_row_if or ignore_row_if_mode
    base = where(df, row_condition).filter(keep_row(column_list, mode))
    vals = F.array_compact(F.array(*[F.col(c).cast("string") for c in column_list]))
    return row_violations(base, F.size(F.array_distinct(vals)) < len(column_list))


def multicolumn_sum_to_equal(df, column_list, sum_total, row_condition=None):
    """Q54: rows where the columns' sum differs from a number or a column."""
    total = F.col(sum_total) if isinstance(sum_total, str) else F.lit(sum_total)
    s = F.col(column_list[0])
    for c in column_list[1:]:
        s = s + F.col(c)
    return row_violations(df, ~(s == total), row_condition)


def column_pair_values_A_to_be_greater_than_B(df, column_A, column_B, or_equal=False, row_condition=None):
    """Q55."""
    a, b = F.col(column_A), F.col(column_B)
    return row_violations(df, ~((a >= b) if or_equal else (a > b)), row_condition)


def column_pair_values_to_be_equal(df, column_A, column_B, row_condition=None):
    """Q56."""
    return row_violations(df, ~(F.col(column_A) == F.col(column_B)), row_condition)


def column_pair_values_to_be_in_set(df, column_A, column_B, value_pairs_set, row_condition=None):
    """Q57: rows whose (A, B) pair is none of the listed pairs."""
    a, b = F.col(column_A), F.col(column_B)
    ok = F.lit(False)
    for x, y in value_pairs_set:
        ok = ok | ((a == F.lit(x)) & (b == F.lit(y)))
    return row_violations(df, ~ok, row_condition)
