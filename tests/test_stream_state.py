import glob
import random
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF001
from marketlake.operators.bronze import to_bronze
from marketlake.plans.stream_state_catalog import forget_last_commit, hot_series, ingest_with_crash
from marketlake.session import scratch_path
from marketlake.sources.adapters import events_as_kafka
from marketlake.streaming import bronze_table as B
from marketlake.streaming import jobs as Z
from marketlake.streaming import state as S


def drain(spark, log, base, checks=None, files=1):
    records = Z.read_records_stream(spark, log, max_files_per_trigger=files)
    B.start_bronze_table(records, f"{base}/table", f"{base}/ck", available_now=True, checks=checks).awaitTermination()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_series_of_one_day_is_written_by_several_tasks(spark):
    base = scratch_path(spark, "t-hot")
    one_day = F.regexp_replace("value", '"event_ts_ms":[0-9]+', '"event_ts_ms":1704067200000')
    records = hot_series(events_as_kafka(spark, "/root/testdata/sf0.01")).withColumn("value", one_day).filter("topic <> 'dlq.trades' AND value LIKE '%event_ts_ms%'")
    records.repartition(8).write.parquet(f"{base}/log")
    # partitions as small as the data: many tasks read, and a target size that the hot series exceeds
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "48k",
            "spark.sql.files.maxPartitionBytes": "200k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        drain(spark, f"{base}/log", base, files=8)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {d: len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{base}/table/data/batch=*/dt=2024-01-01/symbol=*/exchange=*")}
    hot = [n for d, n in files.items() if "HOT-USD" in d]
    assert hot[0] >= 3 and max(n for d, n in files.items() if "HOT-USD" not in d) <= 2
    assert same(B.read_bronze_table(spark, f"{base}/table"), to_bronze(spark.read.parquet(f"{base}/log")))


def test_crash_restart_and_compaction_keep_every_row_once(spark):
    base = scratch_path(spark, "t-crash")
    records = events_as_kafka(spark, SF001)
    table = ingest_with_crash(spark, records, base)
    assert same(B.read_bronze_table(spark, table), to_bronze(records))
    live = B.live_days(spark, table)
    assert live.filter("dt = '2024-01-05'").count() == 1 < live.filter("dt = '2024-01-08'").count()
    assert live.agg(F.sum("row_count")).first()[0] == records.count()
    day = B.read_bronze_table(spark, table, "2024-01-05", "2024-01-06")
    assert same(day, to_bronze(records).filter("dt BETWEEN '2024-01-05' AND '2024-01-06'"))
    assert all("dt=2024-01-05" in f or "dt=2024-01-06" in f for f in day.inputFiles())


def test_crash_before_the_manifest_writes_the_batch_again(spark):
    base = scratch_path(spark, "t-manifest")
    records = events_as_kafka(spark, SF001)
    records.repartition(2).write.parquet(f"{base}/log")
    drain(spark, f"{base}/log", base)
    last = sorted(glob.glob(f"{base}/table/manifest/entry=*"))[-1]
    for f in glob.glob(f"{last}/*") + glob.glob(f"{last}/.*"):
        import os
        os.remove(f)
    assert B.read_bronze_table(spark, f"{base}/table").count() < records.count()
    forget_last_commit(spark, f"{base}/ck")
    drain(spark, f"{base}/log", base)
    assert same(B.read_bronze_table(spark, f"{base}/table"), to_bronze(records))
    # a new checkpoint is another stream: its batch ids mean nothing to the batches of the first
    b = to_bronze(records)
    assert B.write_batch(b, f"{base}/table", "other-0") and not B.write_batch(b, f"{base}/table", "other-0")
    assert B.read_bronze_table(spark, f"{base}/table").count() == 2 * records.count()


def test_checks_while_writing(spark):
    base = scratch_path(spark, "t-checks")
    b = to_bronze(events_as_kafka(spark, SF001))
    checks = [B.RowCheck("dead", F.col("stream_kind") == "dlq"), *B.required(["event_ts_ms"]), B.RowCheck("never", F.col("dt") < "2000", "error")]
    assert B.write_batch(b, base, "s-0", checks)
    got = {r.check_name: r.failures for r in B.violations(spark, base).collect()}
    assert got == {"dead": b.filter("stream_kind = 'dlq'").count(), "event_ts_ms_not_null": b.filter("event_ts_ms IS NULL").count(), "never": 0}
    assert same(B.read_bronze_table(spark, base), b.filter("event_ts_ms IS NOT NULL"))
    with pytest.raises(B.BatchRefused):
        B.write_batch(b, base, "s-1", [B.RowCheck("no_trades", F.col("stream_kind") == "trades", "error")])
    assert B.write_batch(b.limit(0), base, "s-2", checks)  # a batch without rows is committed too
    assert B.read_bronze_table(spark, base).count() == b.filter("event_ts_ms IS NOT NULL").count()
    assert B.read_bronze_table(spark, f"{base}/nothing").count() == 0
    with pytest.raises(ValueError):
        B.RowCheck("x", F.lit(True), "fatal")


def test_refused_batch_stops_the_stream(spark):
    base = scratch_path(spark, "t-refused")
    events_as_kafka(spark, SF001).coalesce(1).write.parquet(f"{base}/log")
    with pytest.raises(StreamingQueryException):
        drain(spark, f"{base}/log", base, [B.RowCheck("no_trades", F.col("stream_kind") == "trades", "error")])
    assert B.manifest(spark, f"{base}/table").isEmpty()
    drain(spark, f"{base}/log", base)  # without the check the same batch goes through
    assert B.read_bronze_table(spark, f"{base}/table").count() == spark.read.parquet(f"{base}/log").count()


def trade_log(spark, path, rows):
    """Kafka-shaped trades: (trade id, offset, seconds, quantity)."""
    for part in rows:
        values = [("k", f'{{"venue":"v","symbol":"S","trade_id":"{t}","event_ts_ms":{1704067200000 + 1000 * sec},"price":"2","quantity":"{q}","ingest_ts":"i{o}"}}',
                   "raw.trades.v1", 0, o, sec) for t, o, sec, q in part]
        df = spark.createDataFrame(values, "key string, value string, topic string, partition int, offset bigint, sec bigint")
        df.withColumn("timestamp", F.timestamp_seconds(F.col("sec") + 1704067200)).drop("sec").coalesce(1).write.mode("append").parquet(path)


def test_best_delivery_wins_until_the_watermark_passes(spark):
    base = scratch_path(spark, "t-best")
    batches = [[("a", 1, 0, 10), ("b", 5, 10, 50), ("b", 4, 10, 40)], [("a", 3, 5, 30), ("c", 6, 100, 60)],
               [("a", 2, 5, 20), ("b", 9, 20, 90), ("z", 20, 4000, 1)], [("d", 21, 4001, 7)],
               [("a", 99, 6, 99), ("e", 30, 9000, 8)]]
    trade_log(spark, f"{base}/log", batches)
    bronze = to_bronze(Z.read_records_stream(spark, f"{base}/log", max_files_per_trigger=1))
    Z.run_available_now(S.stream_best_trades(bronze, "10 minutes", "10 minutes"), f"{base}/out", f"{base}/ck")
    done = {r.trade_id: (r.kafka_offset, int(r.quantity)) for r in spark.read.parquet(f"{base}/out").collect()}
    held = {r.trade_id: (r.kafka_offset, int(r.quantity)) for r in S.open_trades(spark, f"{base}/ck").collect()}
    # the delivery with offset 99 came an hour after the watermark: that is the batch repair's
    assert done == {"a": (3, 30), "b": (9, 90), "c": (6, 60), "z": (20, 1), "d": (21, 7)} and held == {"e": (30, 8)}
    assert S.last_watermark(spark, f"{base}/ck") == 1704067200000 + 1000 * 9000 - 600_000
    assert S.last_watermark(spark, f"{base}/ck") > 0


class State:
    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


def bars_frame(rows):
    return pd.DataFrame({"metric_ts": [pd.Timestamp(t, unit="m") for t, _, _ in rows], "close_price": [c for _, c, _ in rows], "base_volume": [v for _, _, v in rows]})


def test_ring_equals_whole_series_in_any_order():
    rng = random.Random(4)
    for keep in (2000, 400):
        bars = [(t, Decimal(rng.randint(0 if t % 50 == 0 else 1, 500)), Decimal(t % 9)) for t in sorted(rng.sample(range(3000), 600))]
        arrival = sorted(bars, key=lambda b: b[0] + rng.choice([0, 0, 0, 700]))
        state, last, late = State(), {}, []
        for k in range(0, len(arrival), 37):
            out = next(S._ring(keep)(("x", "S"), iter([bars_frame(arrival[k : k + 37])]), state))
            for r in out.itertuples():
                late.append(r.metric_ts) if r.too_late else last.__setitem__(r.metric_ts, r)
        whole = S.rolling_rows([t * 60_000_000 for t, _, _ in bars], [c for _, c, _ in bars], [v for _, _, v in bars], 0)
        assert not late and len(last) == len(whole)
        moves = S.log_returns([c for _, c, _ in bars])
        for k, w in enumerate(whole):
            got = last[w[0]]
            assert got.close_price == w[1] and got.zero_volume_flag == w[6] and got.price_spike_flag == w[7]
            for a, b in zip((got.rolling_avg_close_5m, got.log_close_return, got.volatility, got.volatility_60m), w[2:6]):
                assert (pd.isna(a) and b is None) or abs(a - b) < 1e-12
            part = pd.Series(moves[max(0, k - 59) : k + 1]).dropna()
            assert w[5] is None if len(part) < 2 else abs(w[5] - part.std()) < 1e-12


def test_bars_older_than_the_ring_are_passed_on():
    state, keep = State(), 100
    bars = [(t, Decimal(t % 7 + 1), Decimal(1)) for t in range(300)]
    next(S._ring(keep)(("x", "S"), iter([bars_frame(bars[1:])]), state))
    assert len(state.value[0]) == keep
    out = next(S._ring(keep)(("x", "S"), iter([bars_frame([bars[0], (270, Decimal(3), Decimal(1))])]), state))
    assert out[out.too_late].metric_ts.tolist() == [pd.Timestamp(0, unit="m")]
    kept = out[~out.too_late]
    whole = S.rolling_rows([t * 60_000_000 for t in range(1, 300)], [Decimal(3) if t == 270 else Decimal(t % 7 + 1) for t in range(1, 300)], [Decimal(1)] * 299, 269)
    assert len(kept) == 30 and np.allclose(kept.volatility_60m.astype(float), [w[5] for w in whole])
    with pytest.raises(ValueError):
        S.stream_rolling(None, keep=10)
