"""String-matching checks (Q31-Q40) and regex helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.quality.engines import row_violations

__all__ = ["value_lengths_to_equal", "value_lengths_to_be_between", "match_regex", "not_match_regex",
           "match_regex_list", "not_match_regex_list", "match_like_pattern", "not_match_like_pattern",
           "match_like_pattern_list", "not_match_like_pattern_list", "regex_matches", "validate_flags"]

# Inline flags accepted by Java regular expressions that map to RE2's i, m, s, U.
RE_FLAGS = "imsU"


def validate_flags(flags: str, allowed: str = RE_FLAGS) -> str:
    """Reject unknown flag letters (checked before any job runs).
    Letters after one ``-`` are cleared instead of set, e.g. ``i-s``."""
    on, clear, off = flags.partition("-")
    bad = [f for f in on + off if f not in allowed]
    if bad or clear and not off:
        raise ValueError(f"flags {flags!r} are not supported; allowed: {allowed}, and {allowed} after one '-'")
    return flags


def regex_matches(column, regex: str, flags: str = "", is_raw: bool = False):
    """TRUE when ``regex`` matches anywhere in the value (NULL for NULL).

    Flags become an inline group, e.g. ``(?i)``.  ``U`` (ungreedy) has no
    Java inline equivalent and is rejected.  ``is_raw`` only matters for
    templated SQL (escaping); a Python string is passed through as is.  The
    pattern is checked by the engine that runs it: a malformed one fails the
    query.
    """
    on, _, off = validate_flags(flags).partition("-")
    if "U" in on:
        raise ValueError("ungreedy flag U is not supported by Java regular expressions")
    off = off.replace("U", "")  # it is off anyway
    flags = f"{on}-{off}" if off else on
    pattern = f"(?{flags}){regex}" if flags else regex
    return F.col(column).rlike(pattern)


def value_lengths_to_equal(df, column, value, row_condition=None):
    """Q31: rows whose length differs from ``value`` (NULLs pass)."""
    return row_violations(df, F.length(column) != F.lit(value), row_condition)


def value_lengths_to_be_between(df, column, min_value=None, max_value=None, row_condition=None,
                                strictly=False):
    """Q32."""
    from marketlake.quality.engines import between_predicate
    return row_violations(df, ~between_predicate(F.length(column), min_value, max_value, strictly),
                          row_condition)


def match_regex(df, column, regex, row_condition=None, is_raw=False, flags=""):
    """Q33: rows that do not match."""
    return row_violations(df, ~regex_matches(column, regex, flags, is_raw), row_condition)


def not_match_regex(df, column, regex, row_condition=None, is_raw=False, flags=""):
    """Q34: rows that match."""
    return row_violations(df, regex_matches(column, regex, flags, is_raw), row_condition)


def _combine(preds, match_on):
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be 'any' or 'all'")
    acc = preds[0]
    for p in preds[1:]:
        acc = (acc | p) if match_on == "any" else (acc & p)
    return acc


def match_regex_list(df, column, regex_list, match_on="any", row_condition=None, is_raw=False, flags=""):
    """Q35: rows matching none (any) / not all (all) of the patterns."""
    ok = _combine([regex_matches(column, r, flags, is_raw) for r in regex_list], match_on)
    return row_violations(df, ~ok, row_condition)


def not_match_regex_list(df, column, regex_list, match_on="any", row_condition=None, is_raw=False,
                         flags=""):
    """Q36: passes when at least one ("any") / every ("all") pattern does
    not match; so "any" fails only when all patterns match."""
    ok = _combine([~regex_matches(column, r, flags, is_raw) for r in regex_list], match_on)
    return row_violations(df, ~ok, row_condition)


def match_like_pattern(df, column, like_pattern, row_condition=None):
    """Q37."""
    return row_violations(df, ~F.col(column).like(like_pattern), row_condition)


def not_match_like_pattern(df, column, like_pattern, row_condition=None):
    """Q38."""
    return row_violations(df, F.col(column).like(like_pattern), row_condition)


def match_like_pattern_list(df, column, like_pattern_list, match_on="any", row_condition=None):
    """Q39."""
    ok = _combine([F.col(column).like(p) for p in like_pattern_list], match_on)
    return row_violations(df, ~ok, row_condition)


def not_match_like_pattern_list(df, column, like_pattern_list, match_on="any", row_condition=None):
    """Q40: same combination rule as Q36."""
    ok = _combine([~F.col(column).like(p) for p in like_pattern_list], match_on)
    return row_violations(df, ~ok, row_condition)
