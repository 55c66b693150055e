from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from marketlake.functions import json_value, kafka_key, path_safe, tolerant_bool
from marketlake.operators.bronze import to_bronze
from marketlake.operators.staging import TRADE_PAYLOAD_FIELDS, parse_trades, stg_depth, stg_trades
from marketlake.schemas import BRONZE_COLUMNS

T0 = datetime(2024, 1, 1, 0, 0, 0)


def bronze(spark, rows):
    schema = ("stream_kind string, payload string, exchange string, symbol string, event_ts_ms bigint, "
              "ingest_ts string, kafka_topic string, kafka_partition int, kafka_offset bigint, "
              "kafka_ts timestamp, dt string")
    return spark.createDataFrame(rows, schema).select(*BRONZE_COLUMNS)


def trade(tid, price, qty, ms=1704067200000, flag="true", extra=""):
    ms_part = f'"event_ts_ms": {ms}, ' if ms is not None else ""
    return (f'{{"trade_id": "{tid}", {ms_part}"price": "{price}", "quantity": "{qty}", '
            f'"is_buyer_maker": "{flag}"{extra}}}')


def test_json_value_containers_are_null(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": [1], "d": "x", "e": 2}',)], "v string")
    r = df.select(json_value("v", "$.a").alias("a"), json_value("v", "$.c").alias("c"),
                  json_value("v", "$.d").alias("d"), json_value("v", "$.e").alias("e")).first()
    assert (r.a, r.c, r.d, r.e) == (None, None, "x", "2")


def test_kafka_key_null_propagation_and_path_safe(spark):
    df = spark.createDataFrame([(None, 1, 5, "a/b:c"), ("t", None, 5, None)],
                               "kafka_topic string, kafka_partition int, kafka_offset bigint, s string")
    r = df.select(kafka_key().alias("k"), path_safe("s").alias("p")).collect()
    assert r[0].k == "|1|5" and r[1].k is None
    assert r[0].p == "a-b_c" and r[1].p == "unknown"


def test_tolerant_bool(spark):
    df = spark.createDataFrame([(v,) for v in ["True", "1", "t", "f", "0", "FALSE", "maybe", None]], "v string")
    got = [r.b for r in df.select(tolerant_bool("v").alias("b")).collect()]
    assert got == [True, True, True, False, False, False, None, None]


def test_stg_trades_filters_and_dedups(spark):
    rows = [
        # valid, delivered twice (T7) and replayed at a new offset
        ("trades", trade("1", "10.5", "2"), "x", "S", None, "2024-01-01T00:00:01Z", "raw.trades.v1", 0, 10, T0, "d"),
        ("trades", trade("1", "10.5", "2"), "x", "S", None, "2024-01-01T00:00:01Z", "raw.trades.v1", 0, 10, T0, "d"),
        ("trades", trade("1", "10.5", "2"), "x", "S", None, "2024-01-01T00:00:02Z", "raw.trades.v1", 0, 99, T0, "d"),
        # invalid: bad price, zero quantity, negative price
        ("trades", trade("2", "abc", "1"), "x", "S", None, "z", "raw.trades.v1", 0, 11, T0, "d"),
        ("trades", trade("3", "1", "0"), "x", "S", None, "z", "raw.trades.v1", 0, 12, T0, "d"),
        ("trades", trade("4", "-1", "1"), "x", "S", None, "z", "raw.trades.v1", 0, 13, T0, "d"),
        # missing event time -> kafka_ts
        ("trades", trade("5", "7", "1", ms=None, flag="maybe"), "x", "S", None, "z", "raw.trades.v1", 1, 14, T0, "d"),
        # NULL offsets: NULL key, both rows collapse to one in T7
        ("trades", trade("6", "1", "1"), "x", "S", None, "a", "raw.trades.v1", None, None, T0, "d"),
        ("trades", trade("7", "1", "1"), "x", "S", None, "b", "raw.trades.v1", None, None, T0, "d"),
        ("depth", "{}", "x", "S", None, "z", "raw.depth.v1", 0, 15, T0, "d"),
    ]
    for how in ("window", "aggregate", "fused"):
        t = stg_trades(bronze(spark, rows), dedup=how).orderBy("trade_id").collect()
        ids = [r.trade_id for r in t]
        assert ids[:2] == ["1", "5"] and len(ids) == 3 and ids[2] in ("6", "7")
        one = t[0]
        assert one.kafka_offset == 99 and one.price == Decimal("10.500000000")
        assert t[1].event_ts == T0 and t[1].is_buyer_maker is None
        assert t[2].trade_key is None


def test_stg_depth_validity_and_spread(spark):
    ok = '{"update_id": "u", "event_ts_ms": 1704067200000, "bids": [{"price": "100", "qty": "1"}], ' \
         '"asks": [{"price": "101", "qty": "2"}]}'
    crossed = ok.replace('"101"', '"99"')
    one_sided = '{"update_id": "u", "event_ts_ms": 1, "bids": [{"price": "100", "qty": "1"}], "asks": []}'
    rows = [("depth", p, "x", "S", None, "z", "raw.depth.v1", 0, i, T0, "d")
            for i, p in enumerate([ok, crossed, one_sided, ok])]
    rows[3] = rows[0]  # duplicate delivery
    d = stg_depth(bronze(spark, rows)).collect()
    assert len(d) == 1
    r = d[0]
    assert r.mid_price == Decimal("100.5") and r.spread_abs == Decimal("1")
    assert abs(r.spread_bps - 10000 / 100.5) < 1e-9


def test_carried_fields_are_not_parsed_again(spark):
    """Bronze with the trade fields carried along stages to the same rows, and the payload is parsed once on the whole way."""
    odd = ['{"trade_id": {"a": 1}, "price": "1", "quantity": "2"}', '{"trade_id": "{x", "price": "1e2", "quantity": "2", "venue": {"v": 1}}',
           '{"trade_id": "9", "price": [1], "quantity": 1}', '{"trade_id": "8", "trade_id": "9", "price": "3", "quantity": "1", "symbol": "[s"}',
           "not json", None, trade("5", "7", "1", ms=None), trade("6", "7", "0"), trade("7", "7", "1", ms='"x"', extra=', "symbol": "A/B"')]
    rows = [(v, "raw.trades.v1", p, o, T0) for o, v in enumerate(odd) for p in (0, 1, None)]
    records = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint, timestamp timestamp")
    plain, carried = to_bronze(records), to_bronze(records, TRADE_PAYLOAD_FIELDS)
    want = parse_trades(plain).collect()
    assert len(want) == 27 and sorted(map(str, parse_trades(carried).collect())) == sorted(map(str, want))
    assert stg_trades(carried).columns == stg_trades(plain).columns and stg_depth(carried).columns == stg_depth(plain).columns
    assert stg_trades(carried)._jdf.queryExecution().optimizedPlan().toString().count("json_tuple") == 1


def test_gold_of_lineitem_parses_each_payload_once(spark):
    from marketlake.plans.catalog import q_gold_li

    plan = q_gold_li(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan[: plan.index("] parquet")].count("json_tuple") == 1  # books and dead letters, which lineitem has not, come after it


def test_kafka_identity_groups_like_the_key(spark):
    """NULL topics count as empty ones, and all rows without a partition or an offset are one."""
    ids = [(t, p, o) for t in (None, "", "a", "a|1") for p in (None, 1, 11) for o in (None, 1, 11)]
    rows = [("trades", trade(str(k), "1", "1"), "x", "S", None, "z", *i, T0, "d") for k, i in enumerate(ids * 2)]
    for how in ("window", "aggregate"):
        keys = [r.trade_key for r in stg_trades(bronze(spark, rows), dedup=how).collect()]
        assert len(keys) == len(set(keys)) == 3 * 4 + 1


def test_parse_is_single_json_pass(spark):
    df = bronze(spark, [("trades", trade("1", "1", "1"), "x", "S", None, "z", "t", 0, 1, T0, "d")])
    plan = stg_trades(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple") == 1 and "from_json" not in plan and "get_json_object" not in plan
    assert F  # keep import used
