"""Date column functions (D7-D19) as Column expressions.

Week conventions are arguments, not hidden dialects: ``week_start="sunday"``
(the warehouse default: weeks start on Sunday, week numbers count Sundays)
or ``"monday"`` (ISO).  Functions that the reference anchors on "today"
take an explicit anchor (a Column or a literal date), so they can be applied
to data columns and tested deterministically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["convert_timezone", "date_part", "day_name", "month_name", "day_of_month", "day_of_week",
           "day_of_year", "week_start", "week_end", "iso_week_start", "iso_week_end", "iso_week_of_year",
           "week_of_year", "from_unixtimestamp", "to_unixtimestamp", "round_timestamp", "periods_since",
           "now", "today", "yesterday", "tomorrow", "n_days_ago", "n_days_away", "n_weeks_ago", "n_weeks_away",
           "n_months_ago", "n_months_away", "last_week", "next_week", "last_month", "next_month",
           "last_month_name", "next_month_name", "last_month_number", "next_month_number", "month_end",
           "quarter_end", "year_end"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _d(x) -> Column:
    return _c(x).cast("date")


def convert_timezone(column, target_tz: str, source_tz: str = "UTC") -> Column:
    """Wall-clock time in ``source_tz`` -> wall-clock time in ``target_tz``."""
    return F.from_utc_timestamp(F.to_utc_timestamp(_c(column), source_tz), target_tz)


def date_part(datepart: str, date) -> Column:
    """``date_part('<part>', date)``."""
    return F.date_part(F.lit(datepart), _c(date))


def day_name(date, short: bool = True) -> Column:
    """Sun / Sunday."""
    return F.date_format(_c(date), "E" if short else "EEEE")


def month_name(date, short: bool = True) -> Column:
    """Nov / November."""
    return F.date_format(_c(date), "MMM" if short else "MMMM")


def day_of_month(date) -> Column:
    """D10."""
    return F.dayofmonth(_c(date))


def day_of_week(date, isoweek: bool = True) -> Column:
    """ISO (Monday=1..Sunday=7) or Sunday=1..Saturday=7."""
    dow = F.dayofweek(_c(date))  # Sunday=1
    return F.when(dow == 1, F.lit(7)).otherwise(dow - 1) if isoweek else dow


def day_of_year(date) -> Column:
    """D10."""
    return F.dayofyear(_c(date))


def week_start(date, week_start: str = "sunday") -> Column:
    """First day of the week containing ``date``."""
    d = _d(date)
    if week_start == "monday":
        return F.date_trunc("week", d).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_end(date, week_start_day: str = "sunday") -> Column:
    """Last day of that week."""
    return F.date_add(week_start(date, week_start_day), 6)


def iso_week_start(date) -> Column:
    """Monday of the ISO week."""
    return F.date_trunc("week", _d(date)).cast("date")


def iso_week_end(date) -> Column:
    """D12."""
    return F.date_add(iso_week_start(date), 6)


def iso_week_of_year(date) -> Column:
    """ISO 8601 week number."""
    return F.weekofyear(_d(date))


def week_of_year(date, mode: str = "sunday") -> Column:
    """``sunday`` = weeks beginning on Sunday, days before the year's
    first Sunday are week 0; ``iso`` = ISO week; ``simple`` = ceil(doy/7)."""
    d = _d(date)
    if mode == "iso":
        return F.weekofyear(d)
    if mode == "simple":
        return F.ceil(F.dayofyear(d) / 7).cast("int")
    return F.floor((F.dayofyear(d) - F.dayofweek(d) + 7) / 7).cast("int")


def from_unixtimestamp(epochs, format: str = "seconds") -> Column:
    """Seconds / milliseconds / microseconds since epoch -> timestamp."""
    e = _c(epochs)
    if format == "seconds":
        return F.timestamp_seconds(e)
    if format == "milliseconds":
        return F.timestamp_millis(e.cast("bigint"))
    if format == "microseconds":
        return F.timestamp_micros(e.cast("bigint"))
    raise ValueError(f"value {format} for `format` for from_unixtimestamp is not supported.")


def to_unixtimestamp(ts) -> Column:
    """Whole seconds since epoch."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def round_timestamp(ts) -> Column:
    """Nearest day (``date_trunc(day, ts + 12h)``)."""
    return F.date_trunc("day", _c(ts).cast("timestamp") + F.expr("interval 12 hours"))


def periods_since(date_col, period: str = "day", now=None, tz: str | None = None) -> Column:
    """Period boundaries crossed between ``date_col`` and now (in ``tz``),
    a whole number."""
    n, d = now_col(now, tz), _c(date_col).cast("timestamp")
    p = period.lower()
    if p in ("year", "quarter", "month"):
        per_year = {"year": 1, "quarter": 4, "month": 12}[p]
        part = {"year": lambda x: F.lit(0), "quarter": F.quarter, "month": F.month}[p]
        return (F.year(n) - F.year(d)) * per_year + part(n) - part(d)
    return F.timestamp_diff(p.upper(), F.date_trunc(p, d), F.date_trunc(p, n))


def now_col(now=None, tz: str | None = None) -> Column:
    """The time (UTC session) or ``now``, as the wall clock of ``tz`` if given."""
    n = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
    return F.from_utc_timestamp(n, tz) if tz else n


def now(now=None, tz: str | None = None) -> Column:
    """D17."""
    return now_col(now, tz)


def today(now=None, tz: str | None = None) -> Column:
    """D17."""
    return now_col(now, tz).cast("date")


def _anchor(date, now, tz: str | None = None) -> Column:
    return _d(date) if date is not None else today(now, tz)


def yesterday(date=None, now=None, tz: str | None = None) -> Column:
    """D17."""
    return F.date_sub(_anchor(date, now, tz), 1)


def tomorrow(date=None, now=None, tz: str | None = None) -> Column:
    """D17."""
    return F.date_add(_anchor(date, now, tz), 1)


def n_days_ago(n: int, date=None, now=None, tz: str | None = None) -> Column:
    """D18."""
    return F.date_sub(_anchor(date, now, tz), int(n))


def n_days_away(n: int, date=None, now=None, tz: str | None = None) -> Column:
    """D18."""
    return F.date_add(_anchor(date, now, tz), int(n))


def n_weeks_ago(n: int, date=None, now=None, week_start_day: str = "sunday", tz: str | None = None) -> Column:
    """Start of the week ``n`` weeks back."""
    return week_start(F.date_sub(_anchor(date, now, tz), 7 * int(n)), week_start_day)


def n_weeks_away(n: int, date=None, now=None, week_start_day: str = "sunday", tz: str | None = None) -> Column:
    """D18."""
    return week_start(F.date_add(_anchor(date, now, tz), 7 * int(n)), week_start_day)


def n_months_ago(n: int, date=None, now=None, tz: str | None = None) -> Column:
    """First day of the month ``n`` months back."""
    return F.trunc(F.add_months(_anchor(date, now, tz), -int(n)), "month")


def n_months_away(n: int, date=None, now=None, tz: str | None = None) -> Column:
    """D18."""
    return F.trunc(F.add_months(_anchor(date, now, tz), int(n)), "month")


def last_week(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return n_weeks_ago(1, date, now, tz=tz)


def next_week(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return n_weeks_away(1, date, now, tz=tz)


def last_month(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return n_months_ago(1, date, now, tz)


def next_month(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return n_months_away(1, date, now, tz)


def last_month_name(short: bool = True, date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return month_name(last_month(date, now, tz), short)


def next_month_name(short: bool = True, date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return month_name(next_month(date, now, tz), short)


def last_month_number(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return F.month(last_month(date, now, tz))


def next_month_number(date=None, now=None, tz: str | None = None) -> Column:
    """D19."""
    return F.month(next_month(date, now, tz))


def month_end(date) -> Column:
    return F.last_day(_d(date))


def quarter_end(date) -> Column:
    return F.date_sub(F.add_months(F.trunc(_d(date), "quarter"), 3), 1)


def year_end(date) -> Column:
    return F.make_date(F.year(_d(date)), F.lit(12), F.lit(31))
