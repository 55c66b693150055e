"""Deterministic market feeds derived from the driver's tables.

The driver ships no exchange data, so two tables are mapped onto Kafka-shaped
records (``key, value, topic, partition, offset, timestamp``) that then go
through the real bronze projection:

* ``events``: click/purchase/signup -> trades, view -> order books,
  error -> dead letters.  It also plants the cases the silver layer must
  handle (duplicate deliveries, replays at a new offset, bad prices, zero
  quantity, missing event time, tolerant flags, one-sided and crossed books).
* ``lineitem``: one trade per line (the bench feed, ~6M rows per SF).

Everything is one projection plus one ``explode`` over a single scan.  The
work is split like the input files; only where these give fewer splits than
there are cores (``events`` packs millions of rows into a few MB) the narrow
rows are dealt over the cores first, before they become JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.schemas import TOPIC_DEPTH, TOPIC_DLQ, TOPIC_TRADES

# Fixed parameters of the events mapping (the oracle SQL uses the same).
N_EXCHANGES = 3
N_SYMBOLS = 4
DUP_EVERY = 10          # event_id % 10 == 0 -> delivered twice + replayed
BAD_PRICE_EVERY = 97    # event_id % 97 == 0 -> price "abc"
NO_EVENT_TS_EVERY = 53  # event_id % 53 == 0 -> no event_ts_ms in payload
ONE_SIDED_EVERY = 17    # k % 17 == 0 -> empty asks
CROSSED_EVERY = 19      # k % 19 == 0 -> ask == bid
FLAG_WORDS = ["true", "1", "f", "maybe"]   # indexed by event_id % 4
LI_PART_SPAN = 1 << 27
LI_SUPP_SPAN = 1 << 23

TRADE_TYPES = ["click", "purchase", "signup"]
DEPTH_TYPES = ["view"]
DLQ_TYPES = ["error"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt_over_cores(df: DataFrame) -> DataFrame:
    """``df`` with at least as many partitions as the session has cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, F.xxhash64(*[df[c] for c in df.columns]))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def events_as_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> Kafka-shaped records on the trades, depth and DLQ topics."""
    ev = dealt_over_cores(read_table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    ts = F.col("ts").cast("timestamp")
    ms = F.unix_millis(ts)
    venue = F.concat(F.lit("v"), (F.col("user_id") % N_EXCHANGES).cast("string"))
    symbol = F.concat(F.lit("S"), (F.col("event_id") % N_SYMBOLS).cast("string"), F.lit("/USD"))
    event_ts_ms = F.when(F.col("event_id") % NO_EVENT_TS_EVERY != 0, ms)
    ingest = _iso(ts)
    price_txt = F.when(F.col("event_id") % BAD_PRICE_EVERY == 0, F.lit("abc")) \
        .otherwise(F.col("value").cast("string"))
    flag = F.element_at(F.array(*[F.lit(w) for w in FLAG_WORDS]),
                        (F.col("event_id") % len(FLAG_WORDS) + 1).cast("int"))
    trade = F.to_json(F.struct(
        venue.alias("venue"), symbol.alias("symbol"),
        F.col("event_id").cast("string").alias("trade_id"), event_ts_ms.alias("event_ts_ms"),
        price_txt.alias("price"), k.cast("string").alias("quantity"),
        flag.alias("is_buyer_maker"), ingest.alias("ingest_ts"),
        F.struct("event_type", "user_id").alias("raw_event")))
    cents = F.round(F.col("value") * 100).cast("long")
    ask_cents = F.when(k % CROSSED_EVERY == 0, cents).otherwise(cents + k + 1)
    ask_txt = (ask_cents.cast("decimal(20,0)") / 100).cast("decimal(20,2)").cast("string")
    bids = F.array(F.struct(F.col("value").cast("string").alias("price"), k.cast("string").alias("qty")))
    ask_level = F.struct(ask_txt.alias("price"), (k + 1).cast("string").alias("qty"))
    asks = F.slice(F.array(ask_level), 1, F.when(k % ONE_SIDED_EVERY == 0, 0).otherwise(1))
    book = F.to_json(F.struct(
        venue.alias("venue"), symbol.alias("symbol"),
        F.col("event_id").cast("string").alias("update_id"), event_ts_ms.alias("event_ts_ms"),
        bids.alias("bids"), asks.alias("asks"), ingest.alias("ingest_ts"),
        F.struct("event_type", "user_id").alias("raw_event")))
    dead = F.to_json(F.struct(
        F.lit("binance.trades").alias("source"),
        F.concat(F.lit("schema_validation_failed:event "), F.col("event_id").cast("string")).alias("reason"),
        F.col("props").alias("raw_payload"), ingest.alias("ingest_ts")))
    et = F.col("event_type")
    topic = (F.when(et.isin(*TRADE_TYPES), F.lit(TOPIC_TRADES))
             .when(et.isin(*DEPTH_TYPES), F.lit(TOPIC_DEPTH))
             .when(et.isin(*DLQ_TYPES), F.lit(TOPIC_DLQ)))
    copies = F.when(F.col("event_id") % DUP_EVERY == 0, F.array(F.lit(0), F.lit(1), F.lit(2))) \
        .otherwise(F.array(F.lit(0)))
    # Payloads are built as their own columns first; the topic switch then
    # picks one by name.
    rec = (ev.filter(topic.isNotNull())
           .select("*", F.when(et.isin(*TRADE_TYPES), trade).alias("_trade"),
                   F.when(et.isin(*DEPTH_TYPES), book).alias("_book"),
                   F.when(et.isin(*DLQ_TYPES), dead).alias("_dead"))
           .select(
               F.when(et.isin(*DLQ_TYPES), F.lit("binance.trades"))
               .otherwise(F.concat_ws(":", venue, symbol)).alias("key"),
               F.when(et.isin(*TRADE_TYPES), F.col("_trade"))
               .when(et.isin(*DEPTH_TYPES), F.col("_book"))
               .otherwise(F.col("_dead")).alias("value"),
               topic.alias("topic"),
               (F.col("user_id") % 6).cast("int").alias("partition"),
               F.col("event_id").alias("offset"), ts.alias("timestamp"),
               F.explode(copies).alias("_copy")))
    # offset 2*event_id; the replay (copy 2) lands right after it at 2*event_id + 1
    return rec.select(
        "key", "value", "topic", "partition",
        (F.col("offset") * 2 + F.when(F.col("_copy") == 2, F.lit(1)).otherwise(F.lit(0))).alias("offset"),
        "timestamp")


def lineitem_as_kafka(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` -> one trade record per line (bench feed).

    exchange ``x<suppkey % 4>``, symbol ``P<partkey % 16>``, price =
    l_extendedprice, quantity = l_quantity, event time = l_shipdate.
    ``(orderkey, linenumber)`` alone repeats in the driver's lineitem, so the
    trade id is ``orderkey-linenumber-partkey-suppkey`` and the Kafka identity
    spreads the same four keys over both columns: partition =
    linenumber * 2^27 + partkey mod 2^27, offset = orderkey * 2^23 + suppkey
    mod 2^23.  No overflow below orderkey 2^40; injective while partkey <
    2^27 and suppkey < 2^23.
    """
    li = read_table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate").cast("timestamp")
    venue = F.concat(F.lit("x"), (F.col("l_suppkey") % 4).cast("string"))
    symbol = F.concat(F.lit("P"), (F.col("l_partkey") % 16).cast("string"))
    payload = F.to_json(F.struct(
        venue.alias("venue"), symbol.alias("symbol"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("trade_id"),
        F.unix_millis(ts).alias("event_ts_ms"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("string").alias("quantity"),
        (F.col("l_returnflag") == "R").alias("is_buyer_maker"),
        _iso(ts).alias("ingest_ts")))
    return li.select(
        F.concat_ws(":", venue, symbol).alias("key"), payload.alias("value"),
        F.lit(TOPIC_TRADES).alias("topic"),
        (F.col("l_linenumber") * LI_PART_SPAN + F.col("l_partkey") % LI_PART_SPAN).cast("int").alias("partition"),
        (F.col("l_orderkey") * LI_SUPP_SPAN + F.col("l_suppkey") % LI_SUPP_SPAN).alias("offset"),
        ts.alias("timestamp"))
