"""Silver staging: typed, validated, de-duplicated trades and books."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import (
    computed_once, json_query, kafka_key, mid, safe_divide, scalar_field, scalar_text, spread, to_price, tolerant_bool,
    with_json_fields,
)
from marketlake.operators.dedup import first_per_key, latest_per_key
from marketlake.schemas import STG_DEPTH_COLUMNS, STG_TRADES_COLUMNS

TRADE_PAYLOAD_FIELDS = ["event_ts_ms", "trade_id", "price", "quantity", "is_buyer_maker"]


def uncarried(bronze: DataFrame) -> list[str]:
    """Its columns without the payload's fields that ``to_bronze`` carried along."""
    return [c for c in bronze.columns if not c.startswith("_j_")]


def parse_trades(bronze: DataFrame) -> DataFrame:
    """Trades rows of bronze with typed fields (one JSON parse per row).

    Where ``to_bronze`` carried the fields along, they are not parsed again.
    """
    j = {f: F.col("_j_" + f) for f in TRADE_PAYLOAD_FIELDS}
    trades = bronze.filter(F.col("stream_kind") == "trades")
    if not {"_j_" + f for f in TRADE_PAYLOAD_FIELDS} <= set(bronze.columns):
        trades = with_json_fields(trades, "payload", TRADE_PAYLOAD_FIELDS)
    # the validity filter names these several times: it must find columns there, not the casts to repeat
    typed = computed_once(
        trades, event_ts=F.coalesce(F.timestamp_millis(j["event_ts_ms"].try_cast("bigint")), F.col("kafka_ts")),
        price=to_price(j["price"]), quantity=to_price(j["quantity"]))
    return typed.select(
        *uncarried(bronze), kafka_key().alias("trade_key"), "event_ts", j["trade_id"].alias("trade_id"), "price", "quantity",
        tolerant_bool(j["is_buyer_maker"]).alias("is_buyer_maker"))


def kafka_identity() -> list[F.Column]:
    """Columns that are equal where ``trade_key`` is, or all NULL: numbers sort faster than the key's text."""
    keyed = F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull()
    return [F.when(keyed, c) for c in (F.col("kafka_offset"), F.col("kafka_partition"), F.coalesce("kafka_topic", F.lit("")))]


def valid_trade() -> F.Column:
    """The eight validity conditions."""
    return (F.col("trade_id").isNotNull() & F.col("price").isNotNull() & F.col("quantity").isNotNull()
            & F.col("event_ts").isNotNull() & F.col("exchange").isNotNull() & F.col("symbol").isNotNull()
            & (F.col("price") > 0) & (F.col("quantity") > 0))


def stg_trades(bronze: DataFrame, dedup: str = "window") -> DataFrame:
    """Staged trades, one row per Kafka record and per logical trade.

    T7 keeps the latest ``ingest_ts`` (then ``event_ts``) per Kafka identity;
    T8 keeps the highest offset (then partition, topic) per
    (exchange, symbol, trade_id).  The validity filter runs first, as in the
    reference; it cannot move past the dedup.
    """
    t = parse_trades(bronze).filter(valid_trade())
    t8_order = [F.col("kafka_offset").desc(), F.col("kafka_partition").desc(), F.col("kafka_topic").desc()]
    t7_order = [F.col("ingest_ts").desc(), F.col("event_ts").desc()]
    if dedup == "aggregate":
        t = latest_per_key(t, ["trade_key"], ["ingest_ts", "event_ts"])
        t = latest_per_key(t, ["exchange", "symbol", "trade_id"],
                           ["kafka_offset", "kafka_partition", "kafka_topic"])
    elif dedup == "fused":
        # One shuffle instead of two.  Copies of one Kafka record carry one
        # payload, so each non-NULL trade_key group lies inside one
        # (exchange, symbol, trade_id) group and T7 can run after a shuffle on
        # the trade identity.  The NULL-key group (all rows without partition
        # or offset) collapses to one row across trades: a distributed top-1.
        # Exact unless a Kafka identity is reused for a different trade
        # (e.g. a recreated topic); the default form makes no such assumption.
        null_top = t.filter(F.col("trade_key").isNull()).orderBy(*t7_order).limit(1)
        keyed = t.filter(F.col("trade_key").isNotNull()).unionByName(null_top)
        keyed = keyed.repartition("exchange", "symbol", "trade_id")
        t = first_per_key(keyed, ["exchange", "symbol", "trade_id", "trade_key"], t7_order)
        t = first_per_key(t, ["exchange", "symbol", "trade_id"], t8_order)
    else:
        t = first_per_key(t, kafka_identity(), t7_order)
        t = first_per_key(t, ["trade_id", "exchange", "symbol"], t8_order)  # sorts compare the id, which differs most, first
    return t.select(*STG_TRADES_COLUMNS)


def parse_depth(bronze: DataFrame) -> DataFrame:
    """Depth rows with the first bid/ask level typed.

    The payload is parsed once (``json_tuple``); the first level is then read
    from the much smaller bids/asks text.
    """
    fields = ["event_ts_ms", "update_id", "bids", "asks"]
    bronze = bronze.select(*uncarried(bronze))
    raw = bronze.filter(F.col("stream_kind") == "depth").select(
        "*", F.json_tuple("payload", *fields).alias(*["_j_" + f for f in fields]))
    scalar = lambda f: scalar_field("payload", F.col("_j_" + f), f)
    level = lambda side, f: to_price(scalar_text("_j_" + side, F.col(f"_{side}_{f}"), f"$[0].{f}"))
    # the validity filter names each price several times: it must find columns there, not the parse to repeat
    raw = computed_once(raw, **{f"_{side}_{f}": json_query("_j_" + side, f"$[0].{f}")
                                for side in ("bids", "asks") for f in ("price", "qty")})
    typed = computed_once(
        raw, event_ts=F.coalesce(F.timestamp_millis(scalar("event_ts_ms").try_cast("bigint")), F.col("kafka_ts")),
        update_id=scalar("update_id"), best_bid_price=level("bids", "price"), best_bid_qty=level("bids", "qty"),
        best_ask_price=level("asks", "price"), best_ask_qty=level("asks", "qty"))
    return typed.select(*bronze.columns, kafka_key().alias("depth_key"), "event_ts", "update_id", "best_bid_price",
                        "best_bid_qty", "best_ask_price", "best_ask_qty")


def valid_book() -> F.Column:
    """Ten validity conditions including ask > bid > 0."""
    b, a = F.col("best_bid_price"), F.col("best_ask_price")
    return (b.isNotNull() & a.isNotNull() & F.col("best_bid_qty").isNotNull()
            & F.col("best_ask_qty").isNotNull() & F.col("event_ts").isNotNull()
            & F.col("exchange").isNotNull() & F.col("symbol").isNotNull()
            & (b > 0) & (a > 0) & (a > b))


def stg_depth(bronze: DataFrame, dedup: str = "window") -> DataFrame:
    """Staged top-of-book rows with mid, spread and spread in bps.

    Mid and spread stay exact decimals; the bps ratio is computed in DOUBLE.
    Dedup keeps one row per (topic, partition, offset), latest ingest first.
    """
    b = F.col("best_bid_price")
    a = F.col("best_ask_price")
    d = (parse_depth(bronze)
         .withColumn("mid_price", mid(b, a))
         .withColumn("spread_abs", spread(b, a))
         .filter(valid_book())
         .withColumn("spread_bps", 10000 * safe_divide(F.col("spread_abs").cast("double"),
                                                       F.col("mid_price").cast("double"))))
    keys = ["kafka_topic", "kafka_partition", "kafka_offset"]
    if dedup == "aggregate":
        d = latest_per_key(d, keys, ["ingest_ts"])
    else:
        d = first_per_key(d, keys, [F.col("ingest_ts").desc()])
    return d.select(*STG_DEPTH_COLUMNS)
