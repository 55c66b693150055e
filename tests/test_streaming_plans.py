from pyspark.sql import functions as F

from conftest import SF001
from marketlake.operators.bronze import to_bronze
from marketlake.operators.candles import candle_bars
from marketlake.operators.staging import stg_trades
from marketlake.quality import values_to_be_increasing
from marketlake.session import scratch_path
from marketlake.sources.adapters import events_as_kafka, read_table
from marketlake.sources.bronze import read_bronze, write_bronze_batch
from marketlake.streaming import jobs as Z


def test_stream_equals_batch_on_closed_windows(spark):
    base = scratch_path(spark, "t-stream")
    rec = events_as_kafka(spark, SF001)
    rec.write.parquet(f"{base}/log")
    q = Z.start_bronze_ingest(Z.read_records_stream(spark, f"{base}/log"), f"{base}/bronze", f"{base}/ck",
                              available_now=True)
    q.awaitTermination()
    streamed = read_bronze(spark, f"{base}/bronze").drop("payload")
    batch = to_bronze(rec).drop("payload").select(*streamed.columns)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0

    out = Z.stream_candles_available_now(spark, f"{base}/bronze", f"{base}/c", bucket="day", watermark="1 hour")
    s = spark.read.parquet(out)
    b = candle_bars(stg_trades(read_bronze(spark, f"{base}/bronze")), "day")
    wm = stg_trades(read_bronze(spark, f"{base}/bronze")).agg(F.max("event_ts")).first()[0]
    closed = b.filter(F.col("metric_ts") + F.expr("interval 1 day") <= F.lit(wm) - F.expr("interval 1 hour"))
    assert s.count() == closed.count() > 0
    assert s.exceptAll(closed.select(*s.columns)).count() == 0


def test_bronze_read_prunes_partitions_and_pushes_filters(spark):
    base = scratch_path(spark, "t-prune")
    write_bronze_batch(to_bronze(events_as_kafka(spark, SF001)), base)
    df = read_bronze(spark, base, dt_from="2024-01-05", dt_to="2024-01-06").filter("stream_kind = 'trades'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(stream_kind,trades)" in plan
    try:
        read_bronze(spark, base, require_partition_filter=True)
        raise AssertionError("expected a refusal without dt range")
    except ValueError:
        pass


def test_monotonic_check_has_no_single_partition_window(spark):
    o = read_table(spark, SF001, "orders")
    v = values_to_be_increasing(o, "o_totalprice", sort_column="o_orderkey")
    plan = v._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by the range partition; the only
    # key-less window runs over one row per partition
    assert "windowspecdefinition(_part" in plan
    assert v.count() > 0


def test_frequent_sort_value_is_spread(spark):
    """Half of the rows share one sort value; no task gets them all."""
    from marketlake.operators.ordered import lag_in_order

    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    out = lag_in_order(df, "id", "k")
    assert out.filter("prev_value IS NULL").count() == 1
    assert out.groupBy("prev_value").count().filter("count > 1").count() == 0
    stored = [f for f in out.inputFiles()]
    sizes = [spark.read.parquet(f).filter("k = 7").count() for f in stored]
    assert sum(sizes) == 2001 and max(sizes) < 2000  # the row with id 7 has that value too


def test_restarted_ingest_continues_without_duplicates(spark):
    """One batch, stop, more files, restart from the same checkpoint."""
    base = scratch_path(spark, "t-restart")
    rec = events_as_kafka(spark, SF001)
    for k in (0, 1):
        rec.filter(F.col("offset") % 2 == k).write.mode("append").parquet(f"{base}/log")
        q = Z.start_bronze_ingest(Z.read_records_stream(spark, f"{base}/log"), f"{base}/bronze", f"{base}/ck", available_now=True)
        q.awaitTermination()
    got, want = read_bronze(spark, f"{base}/bronze").drop("payload"), to_bronze(rec).drop("payload")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count()


def test_gold_refresh_prunes_every_input(spark):
    """The inputs are read by literal bounds on their partition columns."""
    from marketlake.sources.silver import read_silver, write_silver

    base = scratch_path(spark, "t-z6")
    write_bronze_batch(to_bronze(events_as_kafka(spark, SF001)), f"{base}/bronze")
    write_silver(stg_trades(read_bronze(spark, f"{base}/bronze")), f"{base}/trades")
    for df, column in ((read_silver(spark, f"{base}/trades", "2024-01-05", "2024-01-06"), "event_date"),
                       (read_bronze(spark, f"{base}/bronze", "2024-01-05", "2024-01-06"), "dt")):
        assert f"PartitionFilters: [isnotnull({column}" in df._jdf.queryExecution().executedPlan().toString()
