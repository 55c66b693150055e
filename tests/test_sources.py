from pyspark.sql import functions as F

from marketlake.quality.strings import regex_matches, validate_flags
from marketlake.functions import json_value, mid, notional, spread, with_json_fields
from marketlake.sources import kafka


def test_text_scalars_may_look_like_containers(spark):
    docs = spark.createDataFrame([('{"a": "[x]1", "b": "{y}"}',), ('{"a": [1], "b": {"c": 1}}',), ('{"a": 3}',)], "d string")
    got = with_json_fields(docs, "d", ["a", "b"]).select("_j_a", "_j_b", json_value("d", "$.a")).collect()
    assert [tuple(r) for r in got] == [("[x]1", "{y}", "[x]1"), (None, None, None), ("3", None, "3")]


def test_wide_decimals_keep_what_they_hold(spark):
    from decimal import Decimal as D
    rows = [(D("0.000000001"), D("250000000000")), (D("123456789.123456789"), D("0.000000003")), (D("1E+20"), D("3E+20"))]
    df = spark.createDataFrame(rows, "b decimal(38,9), a decimal(38,9)")
    got = df.select(notional("b", "a"), mid("b", "a"), spread("b", "a")).collect()
    assert [r[0] for r in got] == [D("250.000000000"), D("0.370370367"), None]
    assert [r[1] for r in got] == [D("125000000000.0000000005"), D("61728394.5617283960"), D("200000000000000000000.0000000000")]
    assert [r[2] for r in got] == [D("249999999999.999999999"), D("-123456789.123456786"), D("200000000000000000000.000000000")]


def test_lost_records_fail_unless_asked_otherwise():
    assert kafka.source_options("b:9092")["failOnDataLoss"] == "true"
    assert kafka.source_options("b:9092", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_routed_rows_reach_their_topic(spark):
    from marketlake.operators.ingest import normalise_all
    from marketlake.session import scratch_path
    from marketlake.sources.raw import events_as_raw_messages
    from conftest import SF001

    raw = events_as_raw_messages(spark, SF001)
    odd = raw.limit(3).withColumn("source", F.lit("nobody"))
    base = scratch_path(spark, "t-routed")
    normalise_all(raw.unionByName(odd)).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{base}/in").schema).parquet(f"{base}/in")
    kafka.start_routed_writer(stream, {}, f"{base}/ck", "parquet", f"{base}/out", available_now=True).awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    want = spark.read.parquet(f"{base}/in").groupBy("topic").count().collect()
    assert {(r.topic, r["count"]) for r in got.groupBy("topic").count().collect()} == {(r.topic, r["count"]) for r in want}
    assert got.filter("topic = 'dlq.trades' AND value LIKE '%unknown source%'").count() == 3


def test_flag_validation(spark):
    assert validate_flags("ims") == "ims" and validate_flags("i-s") == "i-s" and validate_flags("-i") == "-i"
    for bad in ("x", "i-", "i-x", "--i"):
        try:
            validate_flags(bad)
            raise AssertionError("expected ValueError")
        except ValueError:
            pass
    df = spark.createDataFrame([("Abc",), ("abc",), ("äbc",)], "v string")
    got = df.select(regex_matches("v", "^a", "i"), regex_matches("v", "^a", "-i"), regex_matches("v", r"^\p{L}", "m-U")).collect()
    assert [tuple(r) for r in got] == [(True, False, True), (True, True, True), (False, False, True)]


def test_random_values(spark):
    from marketlake.functions import random_value

    one, two = ([r[0] for r in spark.range(50).select(random_value(7)).collect()] for _ in range(2))
    assert one == two and len(set(one)) == 50 and all(0 <= x < 1 for x in one)


def test_built_tables_follow_their_files(spark, tmp_path):
    """Tables are built again once the files that they come from are others; a listing decides, contents are not read."""
    from marketlake.plans.tables import _files_of

    path = str(tmp_path / "events.parquet")
    spark.range(3).coalesce(1).write.parquet(path)
    first = _files_of(spark, path)
    assert first is not None and _files_of(spark, path) == first
    spark.range(2).coalesce(1).write.mode("append").parquet(path)
    assert _files_of(spark, path) != first
