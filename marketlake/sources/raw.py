"""Raw exchange messages (S11): the re-aim of the socket/REST clients as a
scan over captured messages ``(source, raw, recv_ts, recv_seq)``.

``events_as_raw_messages`` derives a deterministic capture from the driver's
``events`` table, including the defects the normalisers must route to the
dead-letter topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.adapters import dealt_over_cores, read_table

RAW_SCHEMA = "source string, raw string, recv_ts timestamp, recv_seq bigint"

# Fixed defect cadence of the capture (the oracle SQL uses the same rules).
MISSING_PRICE_EVERY = 89
BAD_PRICE_EVERY = 97
NOT_JSON_EVERY = 83
SNAPSHOT_EVERY = 7
HEARTBEAT_EVERY = 23
ONE_SIDED_EVERY = 17
NO_USD_EVERY = 11
NO_USD_CC_EVERY = 13
COINS = ["bitcoin", "ethereum"]   # plus one unknown id per user: "wrapped-bitcoin-<user_id>"


def read_raw_messages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Captured messages from files (JSON lines or Parquet) with RAW_SCHEMA."""
    return spark.read.schema(RAW_SCHEMA).format(fmt).load(path)


def events_as_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = dealt_over_cores(read_table(spark, sf_dir, "events"))
    k = F.get_json_object("props", "$.k").try_cast("int")
    eid, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    ms = F.unix_millis(ts)
    val = F.col("value").cast("string")
    et = F.col("event_type")
    binance = F.when(eid % NOT_JSON_EVERY == 0, F.concat(F.lit("{bad json "), eid.cast("string"))).otherwise(
        F.to_json(F.struct(
            F.lit("trade").alias("e"), ms.alias("E"), F.lit("BTCUSDT").alias("s"), eid.alias("t"),
            F.when(eid % MISSING_PRICE_EVERY == 0, F.lit(None).cast("string"))
             .when(eid % BAD_PRICE_EVERY == 0, F.lit("abc")).otherwise(val).alias("p"),
            k.cast("string").alias("q"), (F.col("user_id") % 2 == 0).alias("m"))))
    lvl_b = F.concat(F.lit('[["'), val, F.lit('","'), k.cast("string"), F.lit('","'), ms.cast("string"), F.lit('"]]'))
    ask = (F.col("value") + (k + 1) / 100).cast("decimal(20,2)").cast("string")
    lvl_a = F.concat(F.lit('[["'), ask, F.lit('","'), (k + 1).cast("string"), F.lit('","'), ms.cast("string"),
                     F.lit('"]]'))
    uid = F.col("user_id").cast("string")
    kraken = (F.when(k % HEARTBEAT_EVERY == 0, F.lit('{"event":"heartbeat"}'))
              .when(k % SNAPSHOT_EVERY == 0, F.concat(F.lit("["), uid, F.lit(',{"as":'), lvl_a, F.lit(',"bs":'),
                                                      lvl_b, F.lit('},"book-10","XBT/USDT"]')))
              .when(k % ONE_SIDED_EVERY == 0, F.concat(F.lit("["), uid, F.lit(',{"b":'), lvl_b,
                                                       F.lit('},"book-10","XBT/USDT"]')))
              .otherwise(F.concat(F.lit("["), uid, F.lit(',{"a":'), lvl_a, F.lit('},{"b":'), lvl_b,
                                  F.lit('},"book-10","XBT/USDT"]'))))
    coin = F.when(eid % 3 == 0, F.lit(COINS[0])).when(eid % 3 == 1, F.lit(COINS[1])) \
        .otherwise(F.concat(F.lit("wrapped-bitcoin-"), uid))
    cur = F.when(k % NO_USD_EVERY == 0, F.lit("eur")).otherwise(F.lit("usd"))
    coingecko = F.concat(F.lit('{"'), coin, F.lit('":{"'), cur, F.lit('":'), val, F.lit("}}"))
    cc = F.concat(F.lit('{"'), F.when(k % NO_USD_CC_EVERY == 0, F.lit("EUR")).otherwise(F.lit("USD")),
                  F.lit('":'), val, F.lit("}"))
    source = (F.when(et.isin("click", "error"), F.lit("binance.trades")).when(et == "view", F.lit("kraken.depth"))
              .when(et == "purchase", F.lit("coingecko.rest")).when(et == "signup", F.lit("cryptocompare.rest")))
    raw = (F.when(et == "click", binance).when(et == "error", F.concat(F.lit("not json "), eid.cast("string")))
           .when(et == "view", kraken).when(et == "purchase", coingecko).when(et == "signup", cc))
    return ev.select(source.alias("source"), raw.alias("raw"), ts.alias("recv_ts"), eid.alias("recv_seq"),
                     F.when(et == "purchase", coin).alias("coin_id"))
