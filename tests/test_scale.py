"""What must hold for larger tables: parses aren't repeated by filters, and no single task reads or writes a whole log."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from marketlake.operators.bronze import to_bronze
from marketlake.operators.ingest import normalise_all
from marketlake.operators.staging import stg_depth
from marketlake.plans.stream_state_catalog import drain_by_arrival, ingest_with_crash
from marketlake.schemas import KAFKA_RECORD, TOPIC_DEPTH, TOPIC_TRADES
from marketlake.sources.adapters import dealt_over_cores
from marketlake.streaming.bronze_table import read_bronze_table

T0 = datetime(2024, 1, 1)


def filters(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Filter " in line]


def records(spark, rows):
    return spark.createDataFrame([("k", v, t, 0, i, T0 + timedelta(minutes=i)) for i, (v, t) in enumerate(rows)],
                                 "key string, value string, topic string, partition int, offset bigint, timestamp timestamp")


def test_filter_on_routed_rows_repeats_no_parse(spark):
    raws = [("binance.trades", '{"t": 1, "E": 5, "p": "1.5", "q": "2", "m": true}'), ("binance.trades", "nope"),
            ("kraken.depth", '[1, {"b": [["1", "2"]]}, {"a": [["3", "4"]]}, "book"]'), ("kraken.depth", '{"event": "heartbeat"}'),
            ("coingecko.rest", '{"bitcoin": {"usd": 2.5}}'), ("cryptocompare.rest", '{"EUR": 1}'), (None, "{}")]
    msgs = spark.createDataFrame([(s, r, T0, i, "bitcoin") for i, (s, r) in enumerate(raws)],
                                 "source string, raw string, recv_ts timestamp, recv_seq bigint, coin_id string")
    routed = normalise_all(msgs)
    for topic in ("raw.trades.v1", "dlq.trades"):
        for line in filters(routed.filter(F.col("topic") == topic)):
            assert "from_json" not in line.lower() and "jsontostructs" not in line.lower() and "json_object_keys" not in line.lower()
    got = {r.recv_seq: (r.topic, r.reason and r.reason.split(":")[0]) for r in routed.collect()}
    assert got == {0: ("raw.trades.v1", None), 1: ("dlq.trades", "schema_validation_failed"), 2: ("raw.depth.v1", None),
                   4: ("raw.coingecko.v1", None), 5: ("dlq.trades", "poll_failed"), 6: ("dlq.trades", "schema_validation_failed")}


def test_filter_on_books_repeats_no_parse(spark):
    book = '{"venue":"v","symbol":"S/U","event_ts_ms":1,"update_id":"%d","bids":[{"price":"%s","qty":"1"}],"asks":[{"price":"3","qty":"1"}]}'
    rows = [(book % (1, "2"), TOPIC_DEPTH), (book % (2, "4"), TOPIC_DEPTH), (book % (3, "x"), TOPIC_DEPTH),
            ('{"venue":"v","symbol":"S/U","bids":[{"price":{"a":1},"qty":"1"}],"asks":[]}', TOPIC_DEPTH)]
    depth = stg_depth(to_bronze(records(spark, rows)))
    assert not any("get_json_object" in line for line in filters(depth))
    assert [(r.update_id, str(r.mid_price)) for r in depth.collect()] == [("1", "2.5000000000")]


def test_rows_of_a_compact_file_are_dealt_over_the_cores(spark, tmp_path):
    spark.range(1000).withColumn("x", F.when(F.col("id") % 3 > 0, F.col("id"))).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert df.rdd.getNumPartitions() == 1
    dealt = dealt_over_cores(df)
    assert dealt.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert dealt.exceptAll(df).isEmpty() and dealt.count() == 1000
    assert dealt_over_cores(dealt) is dealt


def test_log_of_arrivals_is_written_by_time_and_size(spark, tmp_path):
    rows = spark.range(0, 60, 1, 4).select("id", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 43200).alias("ts"))
    log, seen = str(tmp_path / "log"), []
    drain_by_arrival(rows.unionByName(rows.limit(1).withColumn("ts", F.lit(None).cast("timestamp"))), F.col("ts"), 5, log,
                     lambda: seen.append(sorted(r.id for r in spark.read.parquet(log).collect())))
    assert seen == [list(range(10 * (k + 1))) for k in range(6)]


def test_crash_log_has_as_many_files_as_its_size_asks_for(spark, tmp_path):
    value = '{"venue":"v1","symbol":"S1/USD","trade_id":"%d","event_ts_ms":1704067200000}'
    rows = records(spark, [(value % i, TOPIC_TRADES) for i in range(64)]).repartition(8)
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, str(4 << 20))  # each small file is a task's
    try:
        table = ingest_with_crash(spark, rows.select(*[f.name for f in KAFKA_RECORD.fields]), str(tmp_path / "z1"))
        assert len(spark.read.parquet(str(tmp_path / "z1/log")).inputFiles()) > 8  # two for each quarter before
        offsets = sorted(r.kafka_offset for r in read_bronze_table(spark, table).select("kafka_offset").collect())
    finally:
        spark.conf.unset(key)
    assert offsets == list(range(64))
