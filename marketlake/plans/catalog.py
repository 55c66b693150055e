"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Keys are ``<inventory id>_<name>`` (SURVEY section 2).  Every query reads the
driver's tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators.candles import candle_bars, candles, depth_bars, dlq_bars
from marketlake.operators.staging import TRADE_PAYLOAD_FIELDS, stg_depth, stg_trades
from marketlake.plans.gold import gold_from_bars
from marketlake.plans.pipeline import events_bronze, lineitem_bronze
from marketlake.plans.present import present
from marketlake.session import ensure_conf

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Register ``fn(spark, sf_dir)``; the session's correctness settings
    (UTC time zone, string partition values) are applied before each run."""
    def deco(fn):
        def run(spark, sf_dir):
            ensure_conf(spark)
            return fn(spark, sf_dir)
        run.__name__ = getattr(fn, "__name__", name)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


CANDLE_R6 = ("rolling_avg_close_5m",)
GOLD_R6 = ("spread_bps", "volatility", "volatility_60m", "avg_mid_price")


@query("b7_bronze_events")
def q_bronze(spark, sf):
    return present(events_bronze(spark, sf).drop("payload"))


@query("t9_stg_trades")
def q_stg_trades(spark, sf):
    return present(stg_trades(events_bronze(spark, sf)))


@query("t14_stg_depth")
def q_stg_depth(spark, sf):
    return present(stg_depth(events_bronze(spark, sf)))


@query("a1_candles_day")
def q_candles_day(spark, sf):
    return present(candles(stg_trades(events_bronze(spark, sf)), "day"), round6=CANDLE_R6)


@query("a1_candles_hour")
def q_candles_hour(spark, sf):
    return present(candles(stg_trades(events_bronze(spark, sf)), "hour"), round6=CANDLE_R6)


@query("a1_candles_lineitem_day")
def q_candles_li(spark, sf):
    return present(candles(stg_trades(lineitem_bronze(spark, sf, TRADE_PAYLOAD_FIELDS)), "day"), round6=CANDLE_R6)


@query("a4_depth_hour")
def q_depth_hour(spark, sf):
    return present(depth_bars(stg_depth(events_bronze(spark, sf)), "hour"),
                   round6=("avg_spread_bps", "avg_mid_price"))


@query("a6_dlq_hour")
def q_dlq_hour(spark, sf):
    return present(dlq_bars(events_bronze(spark, sf), "hour"))


def _gold(bronze: DataFrame, bucket: str) -> DataFrame:
    return gold_from_bars(candle_bars(stg_trades(bronze), bucket), depth_bars(stg_depth(bronze), bucket),
                          dlq_bars(bronze, bucket))


@query("g4_gold_hour")
def q_gold_hour(spark, sf):
    return present(_gold(events_bronze(spark, sf), "hour"), round6=GOLD_R6)


@query("g4_gold_lineitem_day")
def q_gold_li(spark, sf):
    return present(_gold(lineitem_bronze(spark, sf, TRADE_PAYLOAD_FIELDS), "day"), round6=GOLD_R6)


# --- project checks and suites on the pipeline (Q61, Q63, Q65, Q66, Q67) ----

@query("q61_required_json_fields")
def q_required_json(spark, sf):
    from marketlake.quality import required_json_fields
    v = required_json_fields(events_bronze(spark, sf), "payload",
                             ["trade_id", "event_ts_ms", "price", "quantity", "ingest_ts"],
                             row_filter="stream_kind = 'trades'")
    return present(v.select("kafka_topic", "kafka_partition", "kafka_offset", "exchange", "symbol"))


@query("q63_unique_grain_candles")
def q_grain(spark, sf):
    from marketlake.quality import unique_grain
    return present(unique_grain(candles(stg_trades(events_bronze(spark, sf)), "hour")))


@query("q65_source_freshness")
def q_freshness(spark, sf):
    from marketlake.quality import source_freshness
    return present(source_freshness(events_bronze(spark, sf), "kafka_ts", now="2024-01-31 00:00:00"))


@query("q66_suite_fused")
def q_suite(spark, sf):
    from marketlake.quality import CheckSpec, run_suite
    from marketlake.sources.adapters import read_table
    li, o = read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders")
    specs = [
        CheckSpec("li_discount_le_008", "lineitem", "expression_is_true", {"expression": "l_discount <= 0.08"}),
        CheckSpec("li_qty_2_49", "lineitem", "values_to_be_between",
                  {"column": "l_quantity", "min_value": 2, "max_value": 49}, severity="warn"),
        CheckSpec("li_flag_not_r", "lineitem", "values_to_not_be_in_set",
                  {"column": "l_returnflag", "value_set": ["R"]}, error_if="> 20000", warn_if="> 0"),
        CheckSpec("o_priority_in_set", "orders", "values_to_be_in_set",
                  {"column": "o_orderpriority", "value_set": ["1-URGENT", "2-HIGH"]}),
        CheckSpec("o_custkey_unique", "orders", "values_to_be_unique", {"column": "o_custkey"}),
        CheckSpec("li_order_line_unique", "lineitem", "compound_columns_to_be_unique",
                  {"column_list": ["l_orderkey", "l_linenumber"]}, fail_calc="sum(n_records)"),
        CheckSpec("disabled_check", "orders", "values_to_be_null", {"column": "o_orderkey"}, enabled=False),
    ]
    return run_suite(specs, {"lineitem": li, "orders": o})


@query("q67_project_suite")
def q_project_suite(spark, sf):
    from marketlake.plans.suite import project_suite
    from marketlake.quality import run_suite
    from marketlake.plans.tables import pipeline_tables
    return run_suite(project_suite(), pipeline_tables(spark, sf))
