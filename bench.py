"""Headline benchmark: prints ONE JSON line with per-query seconds.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3; the median is reported).  Every query runs to
completion through the ``noop`` sink (full execution, no driver collect) or
writes real files into a fresh scratch folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from marketlake.calendar import date_dimension, fiscal_periods  # noqa: E402
from marketlake.operators.candles import candle_bars, candles, depth_bars, dlq_bars  # noqa: E402
from marketlake.operators.staging import stg_depth, stg_trades  # noqa: E402
from marketlake.plans.gold import gold_from_bars, read_gold, write_gold  # noqa: E402
from marketlake.plans.pipeline import events_bronze, lineitem_bronze  # noqa: E402
from marketlake.plans.serving import rows_per_series, volatility_heatmap  # noqa: E402
from marketlake.quality import CheckSpec, run_suite  # noqa: E402
from marketlake.session import build_session  # noqa: E402
from marketlake.sources.adapters import read_table  # noqa: E402
from marketlake.sources.bronze import read_bronze, write_bronze_batch  # noqa: E402


# P1-P4 and P6 run on the driver's lineitem feed, ~600k trades over 7 years of
# days: a directory per day and series would hold a few rows, so that table is
# flat (set BENCH_BRONZE_LAYOUT=daily|hive to change it).  The *_hive queries
# run on the events feed (30 days) in the layout that the pipeline writes.
LAYOUT = os.environ.get("BENCH_BRONZE_LAYOUT", "flat")


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="marketlake-bench-")
    spark = build_session(f"local[{cpus}]", app="marketlake-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": scratch + "/ckpt"})
    sf = os.path.basename(sf_dir).replace("sf", "")
    bronze_path = f"{scratch}/bronze"
    counter = iter(range(10 ** 6))
    # each driver table is one row group, which is one task; lay the tables out as a
    # pipeline would have them, in several files (not timed)
    for t in ("lineitem", "events", "orders"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(2 * cpus).write.parquet(f"{scratch}/in/{t}.parquet")
    sf_dir = f"{scratch}/in"

    def bronze_all():
        return lineitem_bronze(spark, sf_dir).unionByName(events_bronze(spark, sf_dir))

    def p1_bronze_write():
        write_bronze_batch(bronze_all(), f"{scratch}/bronze_w{next(counter)}", mode="overwrite", layout=LAYOUT)

    # P1 output is also the input of the silver/gold queries
    write_bronze_batch(bronze_all(), bronze_path, mode="overwrite", layout=LAYOUT)
    b = lambda: read_bronze(spark, bronze_path)

    def p2_stg_trades():
        noop(stg_trades(b()))

    def p3_candles_day():
        noop(candles(stg_trades(b()), "day"))

    def p4_gold_mart():
        bb = b()
        g = gold_from_bars(candle_bars(stg_trades(bb), "day"), depth_bars(stg_depth(bb), "day"), dlq_bars(bb, "day"))
        write_gold(g, f"{scratch}/gold{next(counter)}", layout=LAYOUT if LAYOUT == "flat" else "daily")

    li, o = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    specs = [
        CheckSpec("disc", "lineitem", "expression_is_true", {"expression": "l_discount <= 0.08"}),
        CheckSpec("qty", "lineitem", "values_to_be_between", {"column": "l_quantity", "min_value": 2,
                                                             "max_value": 49}),
        CheckSpec("flag", "lineitem", "values_to_not_be_in_set", {"column": "l_returnflag", "value_set": ["R"]}),
        CheckSpec("pair", "lineitem", "column_pair_values_A_to_be_greater_than_B",
                  {"column_A": "l_tax", "column_B": "l_discount", "or_equal": True}),
        CheckSpec("nn", "lineitem", "values_to_not_be_null", {"column": "l_shipdate"}),
        CheckSpec("prio", "orders", "values_to_be_in_set", {"column": "o_orderpriority",
                                                           "value_set": ["1-URGENT", "2-HIGH"]}),
        CheckSpec("uniq", "lineitem", "compound_columns_to_be_unique", {"column_list": ["l_orderkey", "l_linenumber"]}),
    ]

    def p5_quality_suite():
        run_suite(specs, {"lineitem": li, "orders": o}).collect()

    def p7_calendar():
        bounds = o.agg(F.min(F.col("o_orderdate").cast("date")).alias("start_date"),
                       F.max(F.col("o_orderdate").cast("date")).alias("end_date"))
        noop(fiscal_periods(date_dimension(bounds), year_end_month=1, week_start_day=1))

    gold_path = f"{scratch}/gold_serving"
    bb = b()
    write_gold(gold_from_bars(candle_bars(stg_trades(bb), "day"), depth_bars(stg_depth(bb), "day"),
                              dlq_bars(bb, "day")), gold_path, layout=LAYOUT if LAYOUT == "flat" else "daily")

    def p8_serving():
        g = read_gold(spark, gold_path)
        noop(rows_per_series(g, "2002-01-01 00:00:00", days=400))
        noop(volatility_heatmap(g, "2002-01-01 00:00:00", days=400))

    def p6_stream_candles():
        from marketlake.streaming.jobs import stream_candles_available_now
        stream_candles_available_now(spark, bronze_path, f"{scratch}/stream{next(counter)}", bucket="day")

    hive_path = f"{scratch}/bronze_hive"
    write_bronze_batch(events_bronze(spark, sf_dir), hive_path)
    h = lambda: read_bronze(spark, hive_path)

    def p1_bronze_write_hive():
        write_bronze_batch(events_bronze(spark, sf_dir), f"{scratch}/hive_w{next(counter)}")

    def p2_stg_trades_hive():
        noop(stg_trades(h()))

    def p3_candles_minute_hive():
        noop(candles(stg_trades(h()), "minute"))

    def p4_gold_mart_hive():
        hh = h()
        g = gold_from_bars(candle_bars(stg_trades(hh), "minute"), depth_bars(stg_depth(hh), "minute"), dlq_bars(hh, "minute"))
        write_gold(g, f"{scratch}/gold{next(counter)}")

    def p6_stream_micro_batches():
        from marketlake.streaming.jobs import stream_candles_available_now
        stream_candles_available_now(spark, bronze_path, f"{scratch}/stream{next(counter)}", bucket="day",
                                     max_files_per_trigger=max(1, len(b().inputFiles()) // 4))

    qs = {"p1_bronze_write": p1_bronze_write, "p2_stg_trades": p2_stg_trades, "p3_candles_day": p3_candles_day,
          "p4_gold_mart": p4_gold_mart, "p5_quality_suite": p5_quality_suite, "p6_stream_candles": p6_stream_candles,
          "p7_calendar": p7_calendar, "p8_serving": p8_serving, "p1_bronze_write_hive": p1_bronze_write_hive,
          "p2_stg_trades_hive": p2_stg_trades_hive, "p3_candles_minute_hive": p3_candles_minute_hive,
          "p4_gold_mart_hive": p4_gold_mart_hive, "p6_stream_micro_batches": p6_stream_micro_batches}
    only = os.environ.get("BENCH_ONLY")
    res = {}
    for name, fn in qs.items():
        if only and name not in only.split(","):
            continue
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        res[name] = round(statistics.median(times), 3)
    streamed = res.get("p6_stream_micro_batches")
    rate = round(b().count() / streamed) if streamed else None
    spark.stop()
    print(json.dumps({"metric": "median_seconds_total", "value": round(sum(res.values()), 3), "unit": "sec",
                      "queries": res, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "runs": runs, "stream_rows_per_second": rate}))


if __name__ == "__main__":
    main()
