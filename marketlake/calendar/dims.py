"""Date dimension (D4) and 4-5-4 fiscal calendars.

Calendar tables are bounded by the length of the date range, not by data
volume; every attribute of a day is arithmetic on that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.calendar import functions as C
from marketlake.calendar.spine import date_spine


def date_dimension(bounds: DataFrame, start: str = "start_date", end: str = "end_date",
                   week_start: str = "sunday") -> DataFrame:
    """One row per day in [start, end) with 36 calendar attributes."""
    d = date_spine(bounds.select(start, end), "day", start, end).select(F.col("date_day").cast("date").alias("date_day"))
    d = d.select("date_day", F.add_months("date_day", -12).alias("prior_year_date_day"),
                 F.date_sub("date_day", 364).alias("prior_year_over_year_date_day"))
    dd, py, pyoy = F.col("date_day"), F.col("prior_year_date_day"), F.col("prior_year_over_year_date_day")
    return d.select(
        dd,
        C.yesterday(dd).alias("prior_date_day"),
        C.tomorrow(dd).alias("next_date_day"),
        py, pyoy,
        C.day_of_week(dd, isoweek=False).alias("day_of_week"),
        C.day_of_week(dd, isoweek=True).alias("day_of_week_iso"),
        C.day_name(dd, short=False).alias("day_of_week_name"),
        C.day_name(dd, short=True).alias("day_of_week_name_short"),
        C.day_of_month(dd).alias("day_of_month"),
        C.day_of_year(dd).alias("day_of_year"),
        C.week_start(dd, week_start).alias("week_start_date"),
        C.week_end(dd, week_start).alias("week_end_date"),
        C.week_start(pyoy, week_start).alias("prior_year_week_start_date"),
        C.week_end(pyoy, week_start).alias("prior_year_week_end_date"),
        C.week_of_year(dd, "iso" if week_start == "monday" else "sunday").alias("week_of_year"),
        C.iso_week_start(dd).alias("iso_week_start_date"),
        C.iso_week_end(dd).alias("iso_week_end_date"),
        C.iso_week_start(pyoy).alias("prior_year_iso_week_start_date"),
        C.iso_week_end(pyoy).alias("prior_year_iso_week_end_date"),
        C.iso_week_of_year(dd).alias("iso_week_of_year"),
        C.week_of_year(pyoy, "iso" if week_start == "monday" else "sunday").alias("prior_year_week_of_year"),
        C.iso_week_of_year(pyoy).alias("prior_year_iso_week_of_year"),
        F.month(dd).alias("month_of_year"),
        C.month_name(dd, short=False).alias("month_name"),
        C.month_name(dd, short=True).alias("month_name_short"),
        F.trunc(dd, "month").alias("month_start_date"),
        C.month_end(dd).alias("month_end_date"),
        F.trunc(py, "month").alias("prior_year_month_start_date"),
        C.month_end(py).alias("prior_year_month_end_date"),
        F.quarter(dd).alias("quarter_of_year"),
        F.trunc(dd, "quarter").alias("quarter_start_date"),
        C.quarter_end(dd).alias("quarter_end_date"),
        F.year(dd).alias("year_number"),
        F.trunc(dd, "year").alias("year_start_date"),
        C.year_end(dd).alias("year_end_date"),
    )


def _year_end(year: Column, month: int, last_day_of_week: int) -> Column:
    """The day of the week ``last_day_of_week`` (1 = Sunday) that is nearest
    to the end of ``month`` in ``year``: at most three days off, so unique."""
    month_end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    ahead = F.pmod(F.lit(last_day_of_week + 3) - F.dayofweek(month_end), F.lit(7)) - 3
    return F.date_add(month_end, ahead)


def fiscal_year_dates(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                      shift_year: int = 1) -> DataFrame:
    """Each day's fiscal year, its week and its fiscal week of year.

    A fiscal year ends with the week whose last day is nearest to the end of
    ``year_end_month`` (``week_start_day`` counts from 1 = Sunday) and carries
    the number of the calendar year of that month less ``shift_year``.  All of
    it is date arithmetic on the day itself.  Only years that begin after a
    year end inside the range of ``dates`` and end in it are returned; their
    bounds are one aggregate row.
    """
    last = (week_start_day + 5) % 7 + 1
    day, year = F.col("date_day"), F.year("date_day")
    ends = {k: _year_end(year + k, year_end_month, last) for k in (-2, -1, 0, 1)}
    # the year end on or after the day: of the year before (early January), this or the next one
    k = F.when(day <= ends[-1], -1).when(day <= ends[0], 0).otherwise(1)
    end = F.when(k == -1, ends[-1]).when(k == 0, ends[0]).otherwise(ends[1])
    before = F.when(k == -1, ends[-2]).when(k == 0, ends[-1]).otherwise(ends[0])
    week = F.date_sub(day, F.pmod(F.dayofweek(day) - week_start_day, F.lit(7)))
    bounds = dates.agg(F.min("date_day").alias("_first"), F.max("date_day").alias("_last"))
    found = dates.select(day, (year + k - shift_year).alias("fiscal_year_number"),
                         F.date_add(before, 1).alias("fiscal_year_start_date"), end.alias("fiscal_year_end_date"),
                         week.alias("week_start_date"), F.date_add(week, 6).alias("week_end_date"))
    weeks = (F.datediff("week_start_date", "fiscal_year_start_date") / 7).cast("int") + 1
    return (found.crossJoin(F.broadcast(bounds))  # one row
            .filter((F.col("fiscal_year_start_date") > F.col("_first")) & (F.col("fiscal_year_end_date") <= F.col("_last")))
            .select(*found.columns, weeks.alias("fiscal_week_of_year")))


#: Weeks of a 13-week quarter that its first, second and third period begin after.
PERIOD_STARTS = (0, 4, 9)


def fiscal_periods(dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1,
                   shift_year: int = 1) -> DataFrame:
    """Quarters of 4, 5 and 4 weeks; a 53rd week belongs to the last period."""
    week = F.col("fiscal_week_of_year")
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    f = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year) \
        .withColumn("_q", quarter).withColumn("_w", week - 13 * F.col("_q"))
    w = F.col("_w")
    period = F.when(w <= PERIOD_STARTS[1], 1).when(w <= PERIOD_STARTS[2], 2).otherwise(3)
    begun = F.element_at(F.array(*[F.lit(x) for x in PERIOD_STARTS]), period)
    return f.select("date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
                    (w - begun).alias("fiscal_week_of_period"), (F.col("_q") * 3 + period).alias("fiscal_period_number"),
                    (F.col("_q") + 1).alias("fiscal_quarter_number"), period.alias("fiscal_period_of_quarter"))
