from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from marketlake.operators.candles import candle_bars
from marketlake.operators.staging import stg_trades
from marketlake.plans.serving import dlq_alert
from tests_helpers import bronze_rows

T0 = datetime(2024, 1, 1)


def test_hot_symbol_is_reduced_before_the_shuffle(spark):
    # one symbol holds a third of all ticks
    rows = [("x", "HOT" if i % 3 == 0 else f"S{i % 50}", T0 + timedelta(seconds=i), i % 6, i, Decimal(1), Decimal(1))
            for i in range(3000)]
    ticks = spark.createDataFrame(rows, "exchange string, symbol string, event_ts timestamp, kafka_partition int, "
                                        "kafka_offset bigint, price decimal(20,9), quantity decimal(20,9)")
    plan = candle_bars(ticks)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "partial_sum" in plan   # map-side combine before the exchange
    hot = candle_bars(ticks).filter("symbol = 'HOT'").agg(F.sum("trade_count")).first()[0]
    assert hot == 1000


def test_dedup_cuts_duplicates_map_side(spark):
    plan = stg_trades(bronze_rows(spark))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    first_exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in lines[first_exchange + 1:])


def test_dlq_alert_per_minute_removes_series_overcount(spark):
    m = T0 + timedelta(minutes=1)
    gold = spark.createDataFrame([(s, m, m.date(), 4) for s in ("a", "b", "c")],
                                 "symbol string, metric_ts timestamp, metric_date date, dead_letter_count bigint")
    now = (m + timedelta(minutes=2)).isoformat(sep=" ")
    assert dlq_alert(gold, now, threshold=5).first().value == 12.0            # stored grain: 3 series x 4
    r = dlq_alert(gold, now, threshold=5, per_minute=True).first()
    assert r.value == 4.0 and r.firing is False
