"""Contracts, table schemas and the fixed values the pipeline must share."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream pipeline's for right results).
# Topic names, in the order the ingest job subscribes to them.
TOPIC_TRADES = "raw.trades.v1"
TOPIC_DEPTH = "raw.depth.v1"
TOPIC_COINGECKO = "raw.coingecko.v1"
TOPIC_CRYPTOCOMPARE = "raw.cryptocompare.v1"
TOPIC_DLQ = "dlq.trades"
# stream_kind tag for each topic; the dead-letter topic is ours (kind "dlq").
TOPIC_KIND = {
    TOPIC_TRADES: "trades",
    TOPIC_DEPTH: "depth",
    TOPIC_COINGECKO: "coingecko",
    TOPIC_CRYPTOCOMPARE: "cryptocompare",
    TOPIC_DLQ: "dlq",
}
TOPIC_PARTITIONS = 6
DLQ_TOPIC_LIKE = "dlq.%"
UNKNOWN = "unknown"
# Coin id -> ticker overrides for REST quotes; other ids are upper-cased with
# '-' replaced by '_' and cut to 32 characters.
COIN_SYMBOLS = {"bitcoin": "BTC", "ethereum": "ETH"}
COIN_SYMBOL_MAX_LEN = 32
# Tolerant boolean spellings (compared lower-case).
TRUE_WORDS = ("true", "1", "t")
FALSE_WORDS = ("false", "0", "f")
# Reason prefixes for rejected messages.
REASON_SCHEMA = "schema_validation_failed"
REASON_POLL = "poll_failed"
# Anomaly thresholds and window lengths (rows = traded minutes, not time).
PRICE_SPIKE_THRESHOLD = 0.10
ROLLING_CLOSE_ROWS = 5
VOLATILITY_ROWS = 15
VOLATILITY_LONG_ROWS = 60
FRESHNESS_ERROR_SECONDS = 300
DLQ_ALERT_THRESHOLD = 25
# ---------------------------------------------------------------------------

PRICE_TYPE = T.DecimalType(38, 9)  # fixed: the warehouse's numeric type

BRONZE_PARTITION_COLUMNS = ["dt", "symbol", "exchange"]

# Bronze as written (data columns first, then the three path partitions).
BRONZE = T.StructType([
    T.StructField("stream_kind", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("event_ts_ms", T.LongType()),
    T.StructField("ingest_ts", T.StringType()),
    T.StructField("kafka_topic", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_ts", T.TimestampType()),
    T.StructField("dt", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange", T.StringType()),
])

BRONZE_COLUMNS = ["stream_kind", "payload", "exchange", "symbol", "event_ts_ms", "ingest_ts",
                  "kafka_topic", "kafka_partition", "kafka_offset", "kafka_ts", "dt"]

# A Kafka-shaped record, as the Kafka source delivers it after casting value.
KAFKA_RECORD = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

LEVEL = T.StructType([T.StructField("price", PRICE_TYPE), T.StructField("qty", PRICE_TYPE)])

# Contracts: every field is read as STRING first so type rules are ours.
TRADE_FIELDS = ["venue", "symbol", "trade_id", "event_ts_ms", "price", "quantity",
                "is_buyer_maker", "ingest_ts", "raw_event"]
BOOK_FIELDS = ["venue", "symbol", "update_id", "event_ts_ms", "bids", "asks", "ingest_ts", "raw_event"]
QUOTE_FIELDS = ["venue", "symbol", "quote_id", "event_ts_ms", "price_usd", "ingest_ts", "raw_event"]
DLQ_FIELDS = ["source", "reason", "raw_payload", "ingest_ts"]

STG_TRADES_COLUMNS = ["trade_key", "stream_kind", "kafka_topic", "kafka_partition", "kafka_offset",
                      "kafka_ts", "dt", "exchange", "symbol", "trade_id", "event_ts", "price",
                      "quantity", "is_buyer_maker", "ingest_ts"]
STG_DEPTH_COLUMNS = ["depth_key", "stream_kind", "kafka_topic", "kafka_partition", "kafka_offset",
                     "kafka_ts", "dt", "exchange", "symbol", "update_id", "event_ts",
                     "best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty",
                     "mid_price", "spread_abs", "spread_bps", "ingest_ts"]
CANDLE_COLUMNS = ["exchange", "symbol", "metric_ts", "metric_date", "open_price", "high_price",
                  "low_price", "close_price", "base_volume", "trade_count", "vwap",
                  "rolling_avg_close_5m", "zero_volume_flag", "price_spike_flag", "anomaly_flag"]
DEPTH_1M_COLUMNS = ["exchange", "symbol", "metric_ts", "metric_date", "avg_spread_bps",
                    "avg_mid_price", "median_mid_price"]
DLQ_1M_COLUMNS = ["metric_ts", "metric_date", "dead_letter_count"]
GOLD_COLUMNS = ["exchange", "symbol", "metric_ts", "metric_date", "open", "high", "low", "close",
                "volume", "vwap", "spread_bps", "volatility", "volatility_60m", "dead_letter_count",
                "zero_volume_flag", "price_spike_flag", "anomaly_flag", "trade_count",
                "avg_mid_price", "median_mid_price"]
SERIES_KEYS = ["exchange", "symbol"]
