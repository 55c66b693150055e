from datetime import date, datetime

from pyspark.sql import functions as F

from marketlake import calendar as C


def golden(spark):
    return spark.createDataFrame([(date(2020, 11, 29),), (date(2020, 12, 1),)], "d date")


def test_week_conventions_goldens(spark):
    r = golden(spark).select(
        C.week_of_year("d").alias("w"), C.week_start("d").alias("ws"), C.week_end("d").alias("we"),
        C.iso_week_of_year("d").alias("iw"), C.week_start("d", "monday").alias("mws"),
        C.day_of_week("d", isoweek=False).alias("dow"), C.day_of_week("d").alias("idow"),
        C.day_name("d").alias("dn"), C.month_name("d", short=False).alias("mn")).collect()
    # Sunday weeks (warehouse default): 48, 48; starts 2020-11-29; ends 2020-12-05
    assert [x.w for x in r] == [48, 48]
    assert [x.ws for x in r] == [date(2020, 11, 29)] * 2 and [x.we for x in r] == [date(2020, 12, 5)] * 2
    # ISO / Monday weeks: 48, 49; starts 2020-11-23, 2020-11-30
    assert [x.iw for x in r] == [48, 49] and [x.mws for x in r] == [date(2020, 11, 23), date(2020, 11, 30)]
    assert [x.dow for x in r] == [1, 3] and [x.idow for x in r] == [7, 2]
    assert [x.dn for x in r] == ["Sun", "Tue"] and r[0].mn == "November"


def test_time_zone_and_epoch_goldens(spark):
    df = spark.createDataFrame([(1623076520,)], "e bigint")
    r = df.select(C.from_unixtimestamp("e").alias("ts")).select(
        "ts", C.convert_timezone("ts", "America/Los_Angeles").alias("la"),
        C.to_unixtimestamp("ts").alias("back"), C.round_timestamp("ts").alias("r")).first()
    assert r.ts == datetime(2021, 6, 7, 14, 35, 20) and r.la == datetime(2021, 6, 7, 7, 35, 20)
    assert r.back == 1623076520 and r.r == datetime(2021, 6, 8)


def test_spine_end_exclusive_and_dimension(spark):
    b = spark.createDataFrame([(date(2015, 1, 1), date(2022, 12, 31))], "start_date date, end_date date")
    dim = C.date_dimension(b)
    assert dim.count() == 2921
    assert dim.agg(F.max("date_day")).first()[0] == date(2022, 12, 30)
    assert len(dim.columns) == 36
    empty = spark.createDataFrame([(date(2020, 1, 2), date(2020, 1, 1))], "start_date date, end_date date")
    assert C.date_spine(empty).count() == 0


def test_fiscal_periods_454(spark):
    b = spark.createDataFrame([(date(2018, 1, 1), date(2021, 12, 31))], "start_date date, end_date date")
    f = C.fiscal_periods(C.date_dimension(b), year_end_month=1, week_start_day=1)
    per_year = f.groupBy("fiscal_year_number").agg(F.count(F.lit(1)).alias("days"),
                                                    F.max("fiscal_week_of_year").alias("weeks")).collect()
    for r in per_year:
        assert r.days in (364, 371) and r.weeks in (52, 53)
    weeks_per_period = (f.groupBy("fiscal_year_number", "fiscal_period_number")
                        .agg(F.count_distinct("fiscal_week_of_year").alias("w"))
                        .filter("fiscal_period_number <= 3").orderBy("fiscal_year_number", "fiscal_period_number")
                        .collect())
    assert [r.w for r in weeks_per_period[:3]] == [4, 5, 4]


def test_generate_series_rejects_non_positive(spark):
    try:
        C.generate_series(spark, 0)
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    assert C.generate_series(spark, 3).count() == 3


def test_generate_series_in_blocks(spark):
    """A bound that only the data knows: short sequences in several tasks, no number lost or twice."""
    from marketlake.calendar.spine import BLOCK

    n = 3 * BLOCK + 5
    out = C.generate_series(spark.createDataFrame([(n,)], "upper_bound long"))
    tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == 4 and max(r["count"] for r in tasks) == BLOCK
    assert out.agg(F.count_distinct("generated_number"), F.min("generated_number"), F.max("generated_number"), F.count("*")).first() == (n, 1, n, n)
    for n in (1, BLOCK, BLOCK + 1):
        got = C.generate_series(spark.createDataFrame([(n,)], "upper_bound long"))
        assert got.agg(F.count("*"), F.max("generated_number")).first() == (n, n)
    for bad in (0, -3):
        try:
            C.generate_series(spark.createDataFrame([(bad,)], "upper_bound long")).collect()
            raise AssertionError("expected an error")
        except Exception as e:  # raised by the plan
            assert "must be positive" in str(e)
