"""Calendar queries (D1-D19).  Spines and dimensions take their date range
from the data (orders / events), so they grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake import calendar as C
from marketlake.plans.quality_catalog import reg
from marketlake.sources.adapters import read_table

TZ = "America/Los_Angeles"
NOW = "2001-08-15 10:30:00"


def _orders_bounds(s, sf):
    o = read_table(s, sf, "orders")
    return o.agg(F.min(F.col("o_orderdate").cast("date")).alias("start_date"),
                 F.max(F.col("o_orderdate").cast("date")).alias("end_date"))


_B = ("b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders)")


@reg("d1_generate_series", "SELECT CAST(t.generate_series AS BIGINT) AS generated_number FROM "
     "(SELECT count(*) AS n FROM nation) c, generate_series(1, c.n) t")
def _d1(s, sf):
    n = read_table(s, sf, "nation").agg(F.count(F.lit(1)).alias("upper_bound"))
    return C.generate_series(n)


def _spine_sql(step, part, shift="0 DAY"):
    # one value for each boundary between start and end; weeks start on Sunday, so they are counted a day later
    return (f"WITH {_B}, n AS (SELECT s, e, date_diff('{part}', s + INTERVAL {shift}, e + INTERVAL {shift}) AS n FROM b) "
            f"SELECT * FROM (SELECT CAST(s AS TIMESTAMP) + t.k * INTERVAL {step} AS date_{part}, e FROM n, range(0, n.n) t(k)) "
            f"WHERE date_{part} <= e").replace("SELECT * FROM (", f"SELECT date_{part} FROM (")


@reg("d2_date_spine_day", _spine_sql("1 DAY", "day"))
def _d2(s, sf):
    return C.date_spine(_orders_bounds(s, sf), "day")


@reg("d2_date_spine_week", _spine_sql("7 DAY", "week", "1 DAY"))
def _d2w(s, sf):
    return C.date_spine(_orders_bounds(s, sf), "week")


@reg("d2_date_spine_month", _spine_sql("1 MONTH", "month"))
def _d2m(s, sf):
    return C.date_spine(_orders_bounds(s, sf), "month")


@reg("d3_base_dates_hours",
     "WITH b AS (SELECT date_trunc('hour', max(ts)) AS e FROM events) SELECT t.d AS date_hour FROM b, "
     "range(b.e - INTERVAL 672 HOUR, b.e, INTERVAL 1 HOUR) t(d)")
def _d3(s, sf):
    e = read_table(s, sf, "events").agg(F.date_trunc("hour", F.max(F.col("ts").cast("timestamp"))).alias("end_date"))
    bounds = e.select((F.col("end_date") - F.expr("interval 672 hours")).alias("start_date"), "end_date")
    return C.base_dates(bounds, datepart="hour")


@reg("d3_base_dates_last_n", """
WITH d AS (SELECT t.d AS date_day FROM range(TIMESTAMP '2001-05-31', TIMESTAMP '2001-08-01', INTERVAL 1 DAY) t(d))
SELECT date_day, count(o_orderkey) AS order_count FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(date_day AS DATE)
GROUP BY 1""")
def _d3n(s, sf):
    """Orders on each of the last 61 days and today; in Los Angeles it is still 31 July."""
    days = C.base_dates(n_dateparts=61, now="2001-08-01 05:00:00", tz=TZ, spark=s)
    o = read_table(s, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"), "o_orderkey")
    return days.join(o, F.col("date_day").cast("date") == F.col("d"), "left").groupBy("date_day").agg(
        F.count("o_orderkey").alias("order_count"))


DIM_SQL = f"""
{_B},
d0 AS (SELECT CAST(t.d AS DATE) AS date_day FROM b, range(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY) t(d)),
d1 AS (SELECT date_day, CAST(date_day - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day,
              CAST(date_day - INTERVAL 364 DAY AS DATE) AS prior_year_over_year_date_day FROM d0),
dates AS (
SELECT date_day,
  CAST(date_day - INTERVAL 1 DAY AS DATE) AS prior_date_day,
  CAST(date_day + INTERVAL 1 DAY AS DATE) AS next_date_day,
  prior_year_date_day, prior_year_over_year_date_day,
  CAST(dayofweek(date_day) + 1 AS INTEGER) AS day_of_week,
  CAST(isodow(date_day) AS INTEGER) AS day_of_week_iso,
  dayname(date_day) AS day_of_week_name,
  strftime(date_day, '%a') AS day_of_week_name_short,
  CAST(dayofmonth(date_day) AS INTEGER) AS day_of_month,
  CAST(dayofyear(date_day) AS INTEGER) AS day_of_year,
  CAST(date_day - CAST(dayofweek(date_day) AS INTEGER) AS DATE) AS week_start_date,
  CAST(date_day - CAST(dayofweek(date_day) AS INTEGER) + 6 AS DATE) AS week_end_date,
  CAST(prior_year_over_year_date_day - CAST(dayofweek(prior_year_over_year_date_day) AS INTEGER) AS DATE)
    AS prior_year_week_start_date,
  CAST(prior_year_over_year_date_day - CAST(dayofweek(prior_year_over_year_date_day) AS INTEGER) + 6 AS DATE)
    AS prior_year_week_end_date,
  CAST((dayofyear(date_day) - dayofweek(date_day) + 6) // 7 AS INTEGER) AS week_of_year,
  CAST(date_trunc('week', date_day) AS DATE) AS iso_week_start_date,
  CAST(date_trunc('week', date_day) + INTERVAL 6 DAY AS DATE) AS iso_week_end_date,
  CAST(date_trunc('week', prior_year_over_year_date_day) AS DATE) AS prior_year_iso_week_start_date,
  CAST(date_trunc('week', prior_year_over_year_date_day) + INTERVAL 6 DAY AS DATE) AS prior_year_iso_week_end_date,
  CAST(weekofyear(date_day) AS INTEGER) AS iso_week_of_year,
  CAST((dayofyear(prior_year_over_year_date_day) - dayofweek(prior_year_over_year_date_day) + 6) // 7 AS INTEGER)
    AS prior_year_week_of_year,
  CAST(weekofyear(prior_year_over_year_date_day) AS INTEGER) AS prior_year_iso_week_of_year,
  CAST(month(date_day) AS INTEGER) AS month_of_year,
  monthname(date_day) AS month_name,
  strftime(date_day, '%b') AS month_name_short,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start_date,
  last_day(date_day) AS month_end_date,
  CAST(date_trunc('month', prior_year_date_day) AS DATE) AS prior_year_month_start_date,
  last_day(prior_year_date_day) AS prior_year_month_end_date,
  CAST(quarter(date_day) AS INTEGER) AS quarter_of_year,
  CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start_date,
  CAST(date_trunc('quarter', date_day) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
  CAST(year(date_day) AS INTEGER) AS year_number,
  CAST(date_trunc('year', date_day) AS DATE) AS year_start_date,
  make_date(CAST(year(date_day) AS INTEGER), 12, 31) AS year_end_date
FROM d1)"""


@reg("d4_date_dimension", "WITH " + DIM_SQL + "\nSELECT * FROM dates")
def _d4(s, sf):
    return C.date_dimension(_orders_bounds(s, sf))


# The same calendar by counting: Saturdays near the ends of January, and running counts of week starts between them.
FISCAL_SQL = f"""
{_B},
days AS (SELECT CAST(t.d AS DATE) AS d FROM b, range(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY) t(d)),
closings AS (SELECT year(d) AS y, d FROM days
             WHERE dayofweek(d) = 6 AND d BETWEEN make_date(year(d), 1, 28) AND make_date(year(d), 2, 3)),
tagged AS (SELECT d, (SELECT min(c.d) FROM closings c WHERE c.d >= days.d) AS closes,
                  (SELECT max(c.d) FROM closings c WHERE c.d < days.d) AS closed FROM days),
fiscal AS (
  SELECT d AS date_day, CAST(year(closes) - 1 AS INTEGER) AS fiscal_year_number, closed + 1 AS fiscal_year_start_date,
         closes AS fiscal_year_end_date, d - CAST(dayofweek(d) AS INTEGER) AS week_start_date,
         d - CAST(dayofweek(d) AS INTEGER) + 6 AS week_end_date,
         CAST(count(*) FILTER (dayofweek(d) = 0) OVER (PARTITION BY closes ORDER BY d) AS INTEGER) AS fiscal_week_of_year
  FROM tagged WHERE closes IS NOT NULL AND closed IS NOT NULL)"""


@reg("d5_fiscal_year_dates", "WITH " + FISCAL_SQL + "\nSELECT * FROM fiscal")
def _d5(s, sf):
    return C.fiscal_year_dates(C.date_dimension(_orders_bounds(s, sf)), year_end_month=1, week_start_day=1)


# weeks 1 to 53 spelled out: how many weeks each of the twelve periods has
_PERIODS = ", ".join(f"({p + 1}, {n})" for p, n in enumerate([4, 5, 4] * 3 + [4, 5, 5]))


@reg("d6_fiscal_periods", "WITH " + FISCAL_SQL + f""",
sizes(p, n) AS (VALUES {_PERIODS}),
spans AS (SELECT p, n, CAST(sum(n) OVER (ORDER BY p) - n AS INTEGER) AS before FROM sizes)
SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
       fiscal_week_of_year - before AS fiscal_week_of_period, CAST(p AS INTEGER) AS fiscal_period_number,
       CAST((p - 1) // 3 + 1 AS INTEGER) AS fiscal_quarter_number, CAST((p - 1) % 3 + 1 AS INTEGER) AS fiscal_period_of_quarter
FROM fiscal JOIN spans ON fiscal_week_of_year > before AND fiscal_week_of_year <= before + n""")
def _d6(s, sf):
    return C.fiscal_periods(C.date_dimension(_orders_bounds(s, sf)), year_end_month=1, week_start_day=1)


@reg("d7_d16_timestamp_functions", f"""
SELECT event_id, ts,
  timezone('{TZ}', CAST(ts AS TIMESTAMP) AT TIME ZONE 'UTC') AS ts_local,
  CAST(epoch_us(ts) // 1000000 AS BIGINT) AS unix_seconds,
  make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_seconds,
  make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_millis,
  make_timestamp(epoch_us(ts)) AS from_micros,
  date_trunc('day', ts + INTERVAL 12 HOUR) AS rounded_timestamp,
  date_diff('day', date_trunc('day', ts), date_trunc('day', TIMESTAMP '{NOW}')) AS days_since,
  date_diff('hour', date_trunc('hour', ts), date_trunc('hour', TIMESTAMP '{NOW}')) AS hours_since,
  CAST(date_diff('month', date_trunc('month', ts), date_trunc('month', TIMESTAMP '{NOW}')) AS INTEGER) AS months_since
FROM events""")
def _d7(s, sf):
    e = read_table(s, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id", "ts",
        C.convert_timezone(ts, TZ).alias("ts_local"),
        C.to_unixtimestamp(ts).alias("unix_seconds"),
        C.from_unixtimestamp(C.to_unixtimestamp(ts), "seconds").alias("from_seconds"),
        C.from_unixtimestamp(F.unix_millis(ts), "milliseconds").alias("from_millis"),
        C.from_unixtimestamp(F.unix_micros(ts), "microseconds").alias("from_micros"),
        C.round_timestamp(ts).alias("rounded_timestamp"),
        C.periods_since(ts, "day", now=NOW).alias("days_since"),
        C.periods_since(ts, "hour", now=NOW).alias("hours_since"),
        C.periods_since(ts, "month", now=NOW).alias("months_since"))


@reg("d8_d19_date_functions", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(date_part('quarter', o_orderdate) AS INTEGER) AS quarter_part,
  strftime(o_orderdate, '%a') AS day_name_short, dayname(o_orderdate) AS day_name_long,
  strftime(o_orderdate, '%b') AS month_name_short, monthname(o_orderdate) AS month_name_long,
  CAST(dayofmonth(o_orderdate) AS INTEGER) AS day_of_month,
  CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week,
  CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week_iso,
  CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
  CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS week_start,
  CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) + 6 AS week_end,
  CAST(date_trunc('week', o_orderdate) AS DATE) AS iso_week_start,
  CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS iso_week_end,
  CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week_of_year,
  CAST((dayofyear(o_orderdate) - dayofweek(o_orderdate) + 6) // 7 AS INTEGER) AS week_of_year,
  CAST(ceil(dayofyear(o_orderdate) / 7) AS INTEGER) AS week_of_year_simple,
  CAST(o_orderdate AS DATE) - 1 AS yesterday, CAST(o_orderdate AS DATE) + 1 AS tomorrow,
  CAST(o_orderdate AS DATE) - 7 AS n_days_ago_7, CAST(o_orderdate AS DATE) + 10 AS n_days_away_10,
  (CAST(o_orderdate AS DATE) - 14) - CAST(dayofweek(CAST(o_orderdate AS DATE) - 14) AS INTEGER) AS n_weeks_ago_2,
  (CAST(o_orderdate AS DATE) + 7) - CAST(dayofweek(CAST(o_orderdate AS DATE) + 7) AS INTEGER) AS next_week,
  CAST(date_trunc('month', o_orderdate - INTERVAL 3 MONTH) AS DATE) AS n_months_ago_3,
  CAST(date_trunc('month', o_orderdate + INTERVAL 1 MONTH) AS DATE) AS next_month,
  strftime(date_trunc('month', o_orderdate - INTERVAL 1 MONTH), '%b') AS last_month_name,
  monthname(date_trunc('month', o_orderdate + INTERVAL 1 MONTH)) AS next_month_name,
  CAST(month(date_trunc('month', o_orderdate - INTERVAL 1 MONTH)) AS INTEGER) AS last_month_number,
  CAST(month(date_trunc('month', o_orderdate + INTERVAL 1 MONTH)) AS INTEGER) AS next_month_number
FROM orders""")
def _d8(s, sf):
    o = read_table(s, sf, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey", d.cast("date").alias("d"),
        C.date_part("quarter", d).cast("int").alias("quarter_part"),
        C.day_name(d, True).alias("day_name_short"), C.day_name(d, False).alias("day_name_long"),
        C.month_name(d, True).alias("month_name_short"), C.month_name(d, False).alias("month_name_long"),
        C.day_of_month(d).alias("day_of_month"), C.day_of_week(d, isoweek=False).alias("day_of_week"),
        C.day_of_week(d, isoweek=True).alias("day_of_week_iso"), C.day_of_year(d).alias("day_of_year"),
        C.week_start(d).alias("week_start"), C.week_end(d).alias("week_end"),
        C.iso_week_start(d).alias("iso_week_start"), C.iso_week_end(d).alias("iso_week_end"),
        C.iso_week_of_year(d).alias("iso_week_of_year"), C.week_of_year(d).alias("week_of_year"),
        C.week_of_year(d, "simple").alias("week_of_year_simple"),
        C.yesterday(d).alias("yesterday"), C.tomorrow(d).alias("tomorrow"),
        C.n_days_ago(7, d).alias("n_days_ago_7"), C.n_days_away(10, d).alias("n_days_away_10"),
        C.n_weeks_ago(2, d).alias("n_weeks_ago_2"), C.next_week(d).alias("next_week"),
        C.n_months_ago(3, d).alias("n_months_ago_3"), C.next_month(d).alias("next_month"),
        C.last_month_name(True, d).alias("last_month_name"), C.next_month_name(False, d).alias("next_month_name"),
        C.last_month_number(d).alias("last_month_number"), C.next_month_number(d).alias("next_month_number"))
