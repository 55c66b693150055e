"""Project-level checks (Q61-Q65) and the suite runner (Q66, Q67)."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import json_query
from marketlake.quality.engines import as_col, row_violations, tag_unique_check, where
from marketlake.schemas import FRESHNESS_ERROR_SECONDS

__all__ = ["required_json_fields", "unique_column_combination", "unique_grain", "source_freshness",
           "CheckSpec", "run_suite", "register_check", "CHECKS"]


def required_json_fields(df, json_column, required_fields, row_filter="1=1"):
    """Q61: rows whose JSON lacks any required field (neither a scalar nor
    an object/array at ``$.<field>``)."""
    # json_query gives scalars and containers alike, so one read per field decides
    miss = reduce(lambda a, b: a | b, [json_query(json_column, f"$.{f}").isNull() for f in required_fields])
    return row_violations(df, miss, row_filter)


def unique_column_combination(df, columns, row_filter="1=1"):
    """Q62: duplicated combinations (NULLs included) with their count."""
    found = where(df, row_filter).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    return tag_unique_check(found, df, columns, None if row_filter == "1=1" else as_col(row_filter))


def unique_grain(df, grain=("exchange", "symbol", "metric_ts")):
    """Q63: grain test for candles, depth roll-ups and gold."""
    return unique_column_combination(df, list(grain))


def source_freshness(df, loaded_at_field="kafka_ts", now=None, error_after_seconds=FRESHNESS_ERROR_SECONDS,
                     strict=False):
    """Q65: one row (max_loaded_at, lag_seconds, status) where status is
    ``pass`` or ``error``.  ``strict=True`` raises on error (the caller's
    job fails), matching a strict freshness run."""
    now_c = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    r = df.agg(F.max(F.col(loaded_at_field)).alias("max_loaded_at")).select(
        "max_loaded_at", (F.unix_timestamp(now_c) - F.unix_timestamp("max_loaded_at")).alias("lag_seconds"))
    r = r.withColumn("status", F.when(F.col("lag_seconds").isNull() | (F.col("lag_seconds") > error_after_seconds),
                                      F.lit("error")).otherwise(F.lit("pass")))
    if strict:
        row = r.first()
        if row is None or row["status"] == "error":
            raise RuntimeError(f"source freshness error: {row}")
    return r


# ---------------------------------------------------------------------------
# Suite runner

CHECKS: dict[str, Callable[..., DataFrame]] = {}


def register_check(name: str, fn: Callable[..., DataFrame]) -> None:
    """Add a user check (``fn(df, **kwargs) -> violations``) by name."""
    CHECKS[name] = fn


@dataclass
class CheckSpec:
    """One declared test: which table, which check, thresholds."""
    name: str
    model: str
    check: str | Callable[..., DataFrame]
    kwargs: dict = field(default_factory=dict)
    severity: str = "error"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"
    fail_calc: str = "count(*)"
    enabled: bool = True
    compare_model: str | None = None


def _resolve(check):
    if callable(check):
        return check
    if check in CHECKS:
        return CHECKS[check]
    import marketlake.quality as q
    return getattr(q, check)


_COMPARE = {"!=": lambda a, b: a != b, "<>": lambda a, b: a != b, "=": lambda a, b: a == b, "==": lambda a, b: a == b,
            ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, "<": lambda a, b: a < b}


def _compare(failures, rule: str):
    """``rule`` is an operator and a whole number, e.g. ``> 10``."""
    m = re.fullmatch(r"\s*(!=|<>|==|=|>=|<=|>|<)\s*(-?\d+)\s*", rule)
    if not m:
        raise ValueError(f"threshold {rule!r} is not an operator and a whole number")
    return _COMPARE[m[1]](failures, F.lit(int(m[2])))


def _result(s: CheckSpec, failures) -> list:
    """The result columns of one check; its thresholds apply to its own row only."""
    hit_err, hit_warn = (_compare(failures, rule) for rule in (s.error_if, s.warn_if))
    status = F.when(hit_err if s.severity == "error" else F.lit(False), F.lit("error")) \
        .when(hit_warn, F.lit("warn")).otherwise(F.lit("pass"))
    return [F.lit(s.name).alias("check_name"), F.lit(s.model).alias("model"),
            failures.cast("bigint").alias("failures"), F.lit(s.severity).alias("severity"), status.alias("status")]


#: Row checks that one bit mask holds, and key columns that one pass over a table groups by.
MASK_BITS, MAX_KEYS = 62, 60


def _one_pass(base: DataFrame, rows: list, keys: list) -> DataFrame:
    """One row with a count ``c<at>`` per check, from one scan and one shuffle.

    ``rows`` are (at, predicate): each row's violated predicates become the
    bits of a mask.  ``keys`` are (at, columns, keep, fail_calc).  Masks and
    key sets are the grouping sets of a single aggregate (one Expand): groups
    by mask are few, and a key set's groups are its distinct keys, counted
    map-side first.
    """
    added, sets = {}, []
    masks = [rows[k:k + MASK_BITS] for k in range(0, len(rows), MASK_BITS)]
    for j, part in enumerate(masks):
        bits = [F.when(p, F.lit(1 << b).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for b, (_, p) in enumerate(part)]
        added[f"_mask{j}"] = reduce(lambda a, b: a + b, bits)
        sets.append((f"_mask{j}",))
    for at, columns, keep, _ in keys:
        if keep is not None:
            added[f"_keep{at}"] = F.coalesce(keep, F.lit(False))
        sets.append((*columns, *([f"_keep{at}"] if keep is not None else [])))
    used = list(dict.fromkeys(c for s in sets for c in s))
    # grouping_id has a bit per column, the first one highest, that is set where the column is not grouped by
    gid = {s: sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in s) for s in sets}
    grouped = base.withColumns(added).groupingSets([[F.col(c) for c in s] for s in dict.fromkeys(sets)], *[F.col(c) for c in used]) \
        .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_set"))
    counts = []
    for j, part in enumerate(masks):
        of = F.col("_set") == gid[(f"_mask{j}",)]
        counts += [F.sum(F.when(of & (F.col(f"_mask{j}").bitwiseAND(F.lit(1 << b).cast("bigint")) != 0), F.col("_n"))).alias(f"c{at}")
                   for b, (at, _) in enumerate(part)]
    for (at, _, keep, calc), s in zip(keys, sets[len(masks):], strict=True):
        bad = (F.col("_set") == gid[s]) & (F.col("_n") > 1) & (F.col(f"_keep{at}") if keep is not None else F.lit(True))
        counts.append((F.sum(F.when(bad, F.col("_n"))) if calc == "sum(n_records)" else F.count_if(bad)).alias(f"c{at}"))
    return grouped.agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"c{at}")
                         for c, at in zip(counts, [at for at, _ in rows] + [k[0] for k in keys], strict=True)])


def run_suite(specs: list[CheckSpec], tables: dict[str, DataFrame]) -> DataFrame:
    """Q66: evaluate checks; one result row per enabled check with
    ``failures`` and ``status`` (pass / warn / error).

    Row checks (``count(*)``) and uniqueness checks (``count(*)`` or
    ``sum(n_records)``) on the same table share one scan and one shuffle: see
    ``_one_pass``; a table with row checks only needs no Expand, they are
    counted together (``count_if(p1), count_if(p2), ...``).  Every other check
    contributes a one-row aggregate.  All parts are unioned into a single
    lazy DataFrame, so the caller's one action runs the whole suite.
    """
    spark = next(iter(tables.values())).sparkSession
    fused: dict[int, tuple[DataFrame, list, list]] = {}
    parts: list[DataFrame] = []
    enabled = [s for s in specs if s.enabled]
    for at, s in enumerate(enabled):
        kw = dict(s.kwargs)
        if s.compare_model:
            kw["compare_df"] = tables[s.compare_model]
        viol = _resolve(s.check)(tables[s.model], **kw)
        row_check, unique = getattr(viol, "_ml_violation", None), getattr(viol, "_ml_unique", None)
        if row_check is not None and s.fail_calc == "count(*)":
            fused.setdefault(id(row_check[0]), (row_check[0], [], []))[1].append((at, row_check[1]))
        elif unique is not None and s.fail_calc in ("count(*)", "sum(n_records)"):
            base, columns, keep = unique
            fused.setdefault(id(base), (base, [], []))[2].append((at, columns, keep, s.fail_calc))
        else:
            one = viol.agg(F.coalesce(F.expr(s.fail_calc).cast("bigint"), F.lit(0)).alias("failures"))
            parts.append(one.select(*_result(s, F.col("failures"))))
    for base, rows, keys in fused.values():
        passes = []
        if rows and not keys:
            passes.append(base.agg(*[F.count_if(p).alias(f"c{at}") for at, p in rows]))
        while keys:
            taken, width = 1, len(keys[0][1]) + 2
            while taken < len(keys) and width + len(keys[taken][1]) + 1 <= MAX_KEYS:
                width, taken = width + len(keys[taken][1]) + 1, taken + 1
            passes.append(_one_pass(base, rows, keys[:taken]))
            rows, keys = [], keys[taken:]
        for counts in passes:
            results = F.array(*[F.struct(*_result(enabled[int(c[1:])], F.col(c))) for c in counts.columns])
            parts.append(counts.select(F.explode(results).alias("r")).select("r.*"))
    if not parts:
        return spark.createDataFrame([], "check_name string, model string, failures bigint, severity string, "
                                         "status string")
    return reduce(lambda a, b: a.unionByName(b), parts)
