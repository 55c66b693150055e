"""Ingest queries: normalisers + contracts + dead-letter routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators.ingest import check_book, check_quote, check_trade, normalise_all
from marketlake.plans.oracle import with_events
from marketlake.plans.pipeline import events_bronze
from marketlake.plans.quality_catalog import reg
from marketlake.session import scratch_path
from marketlake.sources.adapters import read_table
from marketlake.sources.bronze import count_parquet, count_table
from marketlake.sources.raw import events_as_raw_messages

_ROUTED = """
WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
m AS (
  SELECT event_id AS recv_seq,
    CASE WHEN event_type IN ('click', 'error') THEN 'binance.trades' WHEN event_type = 'view' THEN 'kraken.depth'
         WHEN event_type = 'purchase' THEN 'coingecko.rest' ELSE 'cryptocompare.rest' END AS source,
    CASE WHEN event_type = 'error' THEN 'schema_validation_failed'
         WHEN event_type = 'click' AND (event_id % 83 = 0 OR event_id % 89 = 0 OR event_id % 97 = 0)
           THEN 'schema_validation_failed'
         WHEN event_type = 'purchase' AND k % 11 = 0 THEN 'poll_failed'
         WHEN event_type = 'signup' AND k % 13 = 0 THEN 'poll_failed' END AS reason_code,
    CASE WHEN event_type = 'click' THEN 'binance:BTCUSDT' WHEN event_type = 'view' THEN 'kraken:XBT/USDT'
         WHEN event_type = 'signup' THEN 'cryptocompare:BTC'
         WHEN event_type = 'purchase' THEN 'coingecko:' || CASE event_id % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH'
              ELSE substr(upper(replace('wrapped-bitcoin-' || CAST(user_id AS VARCHAR), '-', '_')), 1, 32) END
    END AS ok_key,
    CASE WHEN event_type IN ('click', 'error') THEN 'raw.trades.v1' WHEN event_type = 'view' THEN 'raw.depth.v1'
         WHEN event_type = 'purchase' THEN 'raw.coingecko.v1' ELSE 'raw.cryptocompare.v1' END AS ok_topic
  FROM ev WHERE NOT (event_type = 'view' AND k % 23 = 0))
SELECT CASE WHEN reason_code IS NULL THEN ok_topic ELSE 'dlq.trades' END AS topic,
       CASE WHEN reason_code IS NULL THEN ok_key ELSE source END AS key,
       source, reason_code, recv_seq
FROM m"""


@reg("n1_n5_c6_routed_messages", _ROUTED)
def _routed(s, sf):
    r = normalise_all(events_as_raw_messages(s, sf))
    return r.select("topic", "key", "source", F.substring_index("reason", ":", 1).alias("reason_code"), "recv_seq")


@reg("c1_trade_contract_violations", with_events() + """
SELECT kafka_offset, CASE WHEN event_ts_ms IS NULL THEN 'schema_validation_failed:missing field event_ts_ms'
                          WHEN p_price IS NULL THEN 'schema_validation_failed:price must be a decimal'
                          ELSE 'schema_validation_failed:is_buyer_maker must be a boolean' END AS reason
FROM bronze_x WHERE stream_kind = 'trades' AND (event_ts_ms IS NULL OR p_price IS NULL OR p_flag IS NULL)""")
def _c1(s, sf):
    b = events_bronze(s, sf).filter("stream_kind = 'trades'")
    return b.select("kafka_offset", check_trade("payload").alias("reason")).filter("reason IS NOT NULL")


@reg("c3_quote_contract_violations", """
SELECT event_id, 'schema_validation_failed:' || CASE event_id % 11 WHEN 0 THEN 'missing field price_usd'
       WHEN 1 THEN 'price_usd must be a decimal' WHEN 2 THEN 'venue must be a non-empty string'
       WHEN 3 THEN 'event_ts_ms must be an integer' WHEN 4 THEN 'extra fields note' ELSE 'not a JSON object' END AS reason
FROM events WHERE event_type IN ('purchase', 'signup') AND event_id % 11 < 6""")
def _c3(s, sf):
    # quote messages of the events, one fault planted by a fixed modulo rule
    e = read_table(s, sf, "events").filter("event_type IN ('purchase', 'signup')")
    fault = F.col("event_id") % 11
    doc = F.to_json(F.struct(
        F.when(fault == 2, "").otherwise("coingecko").alias("venue"), F.lit("BTC").alias("symbol"),
        F.concat(F.lit("cg-"), F.col("event_id")).alias("quote_id"),
        F.when(fault == 3, "soon").otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string")).alias("event_ts_ms"),
        F.when(fault == 1, "n/a").when(fault != 0, F.col("value").cast("string")).alias("price_usd"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ingest_ts"), F.struct("event_id").alias("raw_event"),
        F.when(fault == 4, "x").alias("note")))
    quotes = e.select("event_id", F.when(fault == 5, "[]").otherwise(doc).alias("payload"))
    return quotes.select("event_id", check_quote("payload").alias("reason")).filter("reason IS NOT NULL")


@reg("s9_s10_row_counts", "SELECT event_type, count(*) AS parquet_rows, count(*) AS table_rows FROM events GROUP BY 1")
def _s9(s, sf):
    # the same rows counted as a Parquet prefix and as a table of the catalog
    path = scratch_path(s, "prefixes")
    read_table(s, sf, "events").write.partitionBy("event_type").parquet(path)
    kinds = sorted(r.event_type for r in s.read.parquet(path).select("event_type").distinct().collect())
    rows = []
    for kind in kinds:
        s.read.parquet(f"{path}/event_type={kind}").createOrReplaceTempView("prefix_rows")
        rows.append((kind, count_parquet(s, f"{path}/event_type={kind}"), count_table(s, "prefix_rows")))
    s.catalog.dropTempView("prefix_rows")
    return s.createDataFrame(rows, "event_type string, parquet_rows bigint, table_rows bigint")


# --- what the normalisers and the dead-letter envelope carry ---------------------

_EV = """
WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, epoch_us(ts) // 1000 AS ms FROM events),
click AS (SELECT *, CASE WHEN event_id % 83 = 0 THEN 'not a JSON object' WHEN event_id % 89 = 0 THEN 'missing field p'
                         WHEN event_id % 97 = 0 THEN 'invalid decimal price' END AS why FROM ev WHERE event_type = 'click')"""


def _json(path, kind):
    return F.get_json_object("value", path).cast(kind)


@reg("n1_trade_events", _EV + """
SELECT event_id AS recv_seq, 'binance' AS venue, 'BTCUSDT' AS symbol, CAST(event_id AS VARCHAR) AS trade_id,
       ms AS event_ts_ms, CAST(value AS DOUBLE) AS price, CAST(k AS DOUBLE) AS quantity, user_id % 2 = 0 AS is_buyer_maker,
       event_id AS raw_id
FROM click WHERE why IS NULL""")
def _n1(s, sf):
    r = normalise_all(events_as_raw_messages(s, sf)).filter("topic = 'raw.trades.v1'")
    return r.select("recv_seq", *[_json(f"$.{f}", t).alias(f) for f, t in (
        ("venue", "string"), ("symbol", "string"), ("trade_id", "string"), ("event_ts_ms", "bigint"),
        ("price", "double"), ("quantity", "double"), ("is_buyer_maker", "boolean"))],
        _json("$.raw_event.t", "bigint").alias("raw_id"))


@reg("n2_book_events", _EV + """
SELECT event_id AS recv_seq, CAST(ms AS VARCHAR) AS update_id, ms AS event_ts_ms, CAST(value AS DOUBLE) AS bid_price,
       CAST(k AS DOUBLE) AS bid_qty,
       CASE WHEN k % 7 = 0 OR k % 17 <> 0 THEN CAST(CAST(value + (k + 1) / 100 AS DECIMAL(20, 2)) AS DOUBLE) END AS ask_price,
       CASE WHEN k % 7 = 0 OR k % 17 <> 0 THEN CAST(k + 1 AS DOUBLE) END AS ask_qty
FROM ev WHERE event_type = 'view' AND k % 23 <> 0""")
def _n2(s, sf):
    r = normalise_all(events_as_raw_messages(s, sf)).filter("topic = 'raw.depth.v1'")
    return r.select("recv_seq", _json("$.update_id", "string").alias("update_id"),
                    _json("$.event_ts_ms", "bigint").alias("event_ts_ms"),
                    *[_json(f"$.{side}s[0].{f}", "double").alias(f"{side}_{f}") for side in ("bid", "ask")
                      for f in ("price", "qty")])


@reg("n3_n4_quote_events", _EV + """
SELECT event_id AS recv_seq, CASE WHEN event_type = 'signup' THEN 'cryptocompare' ELSE 'coingecko' END AS venue,
       ms AS event_ts_ms, CAST(value AS DOUBLE) AS price_usd
FROM ev WHERE (event_type = 'purchase' AND k % 11 <> 0) OR (event_type = 'signup' AND k % 13 <> 0)""")
def _n3(s, sf):
    r = normalise_all(events_as_raw_messages(s, sf)).filter("topic IN ('raw.coingecko.v1', 'raw.cryptocompare.v1')")
    return r.select("recv_seq", _json("$.venue", "string").alias("venue"),
                    _json("$.event_ts_ms", "bigint").alias("event_ts_ms"), _json("$.price_usd", "double").alias("price_usd"))


@reg("c4_c5_dead_letters", _EV + """,
bad AS (
  SELECT event_id, ts, 'binance.trades' AS source, 'schema_validation_failed:' || why AS reason FROM click WHERE why IS NOT NULL
  UNION ALL SELECT event_id, ts, 'binance.trades', 'schema_validation_failed:not a JSON object' FROM ev WHERE event_type = 'error'
  UNION ALL SELECT event_id, ts, 'coingecko.rest', 'poll_failed:unexpected coingecko payload keys=['
      || CASE event_id % 3 WHEN 0 THEN 'bitcoin' WHEN 1 THEN 'ethereum' ELSE 'wrapped-bitcoin-' || CAST(user_id AS VARCHAR) END || ']'
    FROM ev WHERE event_type = 'purchase' AND k % 11 = 0
  UNION ALL SELECT event_id, ts, 'cryptocompare.rest', 'poll_failed:unexpected cryptocompare payload: {"EUR":'
      || CAST(value AS VARCHAR) || '}' FROM ev WHERE event_type = 'signup' AND k % 13 = 0)
SELECT event_id AS recv_seq, source, reason, reason AS envelope_reason, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingest_ts FROM bad""")
def _c5(s, sf):
    r = normalise_all(events_as_raw_messages(s, sf)).filter("topic = 'dlq.trades'")
    return r.select("recv_seq", _json("$.source", "string").alias("source"), "reason",
                    _json("$.reason", "string").alias("envelope_reason"), _json("$.ingest_ts", "string").alias("ingest_ts"))


@reg("c2_book_contract_violations", with_events() + """
SELECT kafka_offset, 'schema_validation_failed:missing field event_ts_ms' AS reason
FROM bronze_x WHERE stream_kind = 'depth' AND event_ts_ms IS NULL""")
def _c2(s, sf):
    b = events_bronze(s, sf).filter("stream_kind = 'depth'")
    return b.select("kafka_offset", check_book("payload").alias("reason")).filter("reason IS NOT NULL")
