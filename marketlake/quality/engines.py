"""Generic check engines (Q1-Q4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = ["as_col", "where", "expression_is_true", "expression_between", "metric_between",
           "equal_expression", "ignore_row_if", "between_predicate", "row_violations", "tag_row_check", "tag_unique_check"]


def as_col(e) -> Column:
    return F.expr(e) if isinstance(e, str) else e


def where(df: DataFrame, row_condition=None) -> DataFrame:
    return df.filter(as_col(row_condition)) if row_condition is not None else df


def tag_row_check(viol: DataFrame, base: DataFrame, violation: Column) -> DataFrame:
    """Attach ``(base, predicate)`` so the suite runner can count this row
    check together with others on the same table in one aggregate pass."""
    viol._ml_violation = (base, F.coalesce(violation, F.lit(False)))
    return viol


def tag_unique_check(viol: DataFrame, base: DataFrame, columns: list[str], keep: Column | None) -> DataFrame:
    """Attach ``(base, key columns, rows that count)``, so that the suite
    runner can count the duplicated keys of several checks in one pass."""
    viol._ml_unique = (base, list(columns), keep)
    return viol


def row_violations(df: DataFrame, violation: Column, row_condition=None) -> DataFrame:
    """Rows of ``df`` (after ``row_condition``) where ``violation`` is TRUE."""
    found = where(df, row_condition).filter(violation)
    # counted on the whole table, so that checks with different conditions share its scan
    return tag_row_check(found, df, violation if row_condition is None else F.when(as_col(row_condition), violation))


def expression_is_true(df: DataFrame, expression, test_condition: str = "= true", group_by=None,
                       row_condition=None, aggregate: bool = False) -> DataFrame:
    """Q1: rows (or groups) where ``NOT (expression <test_condition>)``.

    A NULL expression is not a violation (``NOT NULL`` is NULL).  With
    ``group_by`` or ``aggregate=True`` the expression is an aggregate and the
    result has the group columns plus ``expression``.
    """
    if group_by or aggregate:
        out = where(df, row_condition).groupBy(*(group_by or [])).agg(as_col(expression).alias("expression"))
        return out.filter(F.expr(f"NOT (expression {test_condition})"))
    if isinstance(expression, str):
        violation = F.expr(f"NOT (({expression}) {test_condition})")
    elif test_condition.replace(" ", "").lower() == "=true":
        violation = ~(expression == F.lit(True))
    else:
        raise ValueError("a Column expression supports only test_condition '= true'")
    return row_violations(df, violation, row_condition)


def between_predicate(e: Column, min_value=None, max_value=None, strictly: bool = False) -> Column:
    """``1=1 [and e >(=) min] [and e <(=) max]`` as a Column."""
    if min_value is None and max_value is None:
        raise ValueError("You have to provide either a min_value, max_value or both.")
    c = F.lit(True)
    if min_value is not None:
        c = c & ((e > F.lit(min_value)) if strictly else (e >= F.lit(min_value)))
    if max_value is not None:
        c = c & ((e < F.lit(max_value)) if strictly else (e <= F.lit(max_value)))
    return c


def expression_between(df: DataFrame, expression, min_value=None, max_value=None, group_by=None,
                       row_condition=None, strictly: bool = False, aggregate: bool = False) -> DataFrame:
    """Q2: violations of ``min <= expression <= max`` (strict with ``strictly``)."""
    e = as_col(expression)
    ok = between_predicate(e, min_value, max_value, strictly)
    if group_by or aggregate:
        return metric_between(df, e, min_value, max_value, group_by, row_condition, strictly, name="expression")
    return row_violations(df, ~ok, row_condition)


def metric_between(df: DataFrame, metric: Column, min_value=None, max_value=None, group_by=None,
                   row_condition=None, strictly: bool = False, name: str = "metric") -> DataFrame:
    """Aggregate ``metric`` per group (or globally) and keep groups outside
    the bounds.  Partial aggregation happens map-side; only one row per group
    and map task crosses the shuffle."""
    base = where(df, row_condition)
    agg = base.groupBy(*(group_by or [])).agg(metric.alias(name))
    ok = between_predicate(F.col(name), min_value, max_value, strictly)
    return agg.filter(~ok)


def equal_expression(df: DataFrame, expression, compare_df: DataFrame | None = None,
                     compare_expression=None, group_by=None, compare_group_by=None,
                     row_condition=None, compare_row_condition=None, tolerance: float = 0.0,
                     tolerance_percent: float | None = None) -> DataFrame:
    """Q3: compare an aggregate of two tables (per group or overall).

    Missing groups count as 0; ``expression_difference_percent`` is relative
    to the left value (NULL when it is 0, which passes).  Both sides are
    aggregated first, so the join only sees one row per group.
    """
    compare_df = df if compare_df is None else compare_df
    compare_expression = expression if compare_expression is None else compare_expression
    compare_row_condition = row_condition if compare_row_condition is None else compare_row_condition
    compare_group_by = group_by if compare_group_by is None else compare_group_by
    n = len(group_by or [])
    a = where(df, row_condition).groupBy(*[F.col(c).alias(f"col_{i + 1}") for i, c in enumerate(group_by or [])]) \
        .agg(as_col(expression).alias("expression"))
    b = where(compare_df, compare_row_condition) \
        .groupBy(*[F.col(c).alias(f"col_{i + 1}") for i, c in enumerate(compare_group_by or [])]) \
        .agg(as_col(compare_expression).alias("compare_expression"))
    if n:
        keys = [f"col_{i + 1}" for i in range(n)]
        cond = [a[k] == b[k] for k in keys]
        j = a.join(b, cond, "full_outer").select(
            *[F.coalesce(a[k], b[k]).alias(k) for k in keys], a["expression"], b["compare_expression"])
    else:
        # Two single-row global aggregates: a 1 x 1 product.
        j = a.crossJoin(b)
    diff = F.abs(F.coalesce("expression", F.lit(0)) - F.coalesce("compare_expression", F.lit(0)))
    j = j.withColumn("expression_difference", diff).withColumn(
        "expression_difference_percent",
        F.col("expression_difference") / F.nullif(F.col("expression") * 1.0, F.lit(0)))
    if tolerance_percent:
        return j.filter(F.col("expression_difference_percent") > tolerance_percent)
    return j.filter(F.col("expression_difference") > tolerance)


def ignore_row_if(columns: list[str], mode: str = "all_values_are_missing") -> Column:
    """Q4: keep-row predicate; ``all_values_are_missing`` drops rows where
    every column is NULL, ``any_value_is_missing`` where any is NULL."""
    if mode not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError("`ignore_row_if` must be one of all_values_are_missing, any_value_is_missing. "
                         f"Got: '{mode}'.")
    nulls = [F.col(c).isNull() for c in columns]
    acc = nulls[0]
    for n_ in nulls[1:]:
        acc = (acc & n_) if mode == "all_values_are_missing" else (acc | n_)
    return ~acc
