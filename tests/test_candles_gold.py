from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from marketlake.operators.candles import candle_bars, candles, depth_bars, dlq_bars, fill_gaps
from marketlake.plans.gold import gold_from_bars

T0 = datetime(2024, 1, 1, 0, 0, 0)
SCHEMA = ("exchange string, symbol string, event_ts timestamp, kafka_partition int, kafka_offset bigint, "
          "price decimal(20,9), quantity decimal(20,9)")


def ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_open_close_tie_break_and_vwap(spark):
    D = Decimal
    rows = [("x", "S", T0, 1, 5, D("10"), D("1")), ("x", "S", T0, 0, 9, D("11"), D("3")),
            ("x", "S", T0 + timedelta(seconds=30), 0, 1, D("12"), D("0")),
            ("x", "S", T0 + timedelta(seconds=30), 0, 2, D("9"), D("0"))]
    b = candle_bars(ticks(spark, rows)).first()
    # same millisecond: partition 0 sorts before partition 1
    assert b.open_price == D("11") and b.close_price == D("9")
    assert b.high_price == D("12") and b.low_price == D("9") and b.trade_count == 4
    assert b.base_volume == D("4") and abs(b.vwap - (11 * 3 + 10) / 4) < 1e-12


def test_zero_volume_vwap_null_and_spike_rows_frame(spark):
    D = Decimal
    prices = [100, 100, 100, 100, 112]
    rows = [("x", "S", T0 + timedelta(minutes=3 * i), 0, i, D(p), D("1")) for i, p in enumerate(prices)]
    rows.append(("y", "S", T0, 0, 99, D("5"), D("0")))
    c = {(r.exchange, r.metric_ts): r for r in candles(ticks(spark, rows)).collect()}
    y = c[("y", T0)]
    assert y.vwap is None and y.zero_volume_flag and y.anomaly_flag
    last = c[("x", T0 + timedelta(minutes=12))]
    # 5-row frame over traded minutes (gaps ignored): avg = 102.4, jump = 9.4% -> no spike
    assert abs(float(last.rolling_avg_close_5m) - 102.4) < 1e-9 and not last.price_spike_flag
    rows2 = rows[:4] + [("x", "S", T0 + timedelta(minutes=12), 0, 4, D("115"), D("1"))]
    last2 = [r for r in candles(ticks(spark, rows2)).collect() if r.exchange == "x"][-1]
    assert last2.price_spike_flag and last2.anomaly_flag


def test_fill_gaps_makes_zero_volume(spark):
    D = Decimal
    rows = [("x", "S", T0, 0, 1, D("1"), D("1")), ("x", "S", T0 + timedelta(minutes=3), 0, 2, D("1"), D("1"))]
    f = fill_gaps(candle_bars(ticks(spark, rows))).orderBy("metric_ts").collect()
    assert len(f) == 4 and f[1].base_volume == 0 and f[1].trade_count == 0


def test_gold_joins_and_volatility(spark):
    D = Decimal
    rows = [("x", "S", T0 + timedelta(minutes=i), 0, i, D(100 + i), D("1")) for i in range(4)]
    rows += [("z", "S", T0 + timedelta(minutes=i), 0, 10 + i, D(50), D("1")) for i in range(2)]
    bars = candle_bars(ticks(spark, rows))
    depth = spark.createDataFrame(
        [("x", "S", T0 + timedelta(minutes=1), 5.0, D("101"))],
        "exchange string, symbol string, event_ts timestamp, spread_bps double, mid_price decimal(21,10)")
    bronze = spark.createDataFrame([("dlq.trades", T0 + timedelta(minutes=1))] * 3,
                                   "kafka_topic string, kafka_ts timestamp")
    g = gold_from_bars(bars, depth_bars(depth), dlq_bars(bronze)).orderBy("exchange", "metric_ts").collect()
    assert len(g) == 6
    x1 = g[1]
    assert x1.spread_bps == 5.0 and x1.median_mid_price == D("101")
    # DLQ joins on the minute only: every series of that minute carries the count
    assert [r.dead_letter_count for r in g if r.metric_ts == T0 + timedelta(minutes=1)] == [3, 3]
    assert g[0].volatility is None and g[1].volatility is None  # one return -> NULL stddev
    assert g[2].volatility is not None
    z = [r for r in g if r.exchange == "z"]
    assert z[1].volatility is None  # ln(1) = 0 twice? only one return -> NULL
    assert F


def test_gold_plan_one_series_shuffle(spark):
    D = Decimal
    rows = [("x", "S", T0 + timedelta(minutes=i), 0, i, D(100 + i), D("1")) for i in range(3)]
    bars = candle_bars(ticks(spark, rows))
    depth = spark.createDataFrame([], "exchange string, symbol string, event_ts timestamp, spread_bps double, "
                                      "mid_price decimal(21,10)")
    bronze = spark.createDataFrame([], "kafka_topic string, kafka_ts timestamp")
    plan = gold_from_bars(bars, depth_bars(depth), dlq_bars(bronze))._jdf.queryExecution() \
        .executedPlan().toString()
    # every window partitions by series; no single-partition window
    assert "SinglePartition" not in plan
