"""Normalisers (N1-N5), contract checks (C1-C5) and dead-letter routing.

The producers' per-message Python (parse, validate, publish or dead-letter)
becomes one row-local projection over a message table: every message gets
its normalised event and a reject ``reason`` (NULL when valid) in the same
pass, and ``route`` turns both outcomes into Kafka rows (topic, key, value)
without splitting the job.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import computed_once
from marketlake.schemas import (
    BOOK_FIELDS, COIN_SYMBOL_MAX_LEN, COIN_SYMBOLS, PRICE_TYPE, QUOTE_FIELDS, REASON_POLL, REASON_SCHEMA, TOPIC_COINGECKO,
    TOPIC_CRYPTOCOMPARE, TOPIC_DEPTH, TOPIC_DLQ, TOPIC_TRADES, TRADE_FIELDS, UNKNOWN,
)

DECIMAL_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INT_RE = r"^[+-]?\d+$"
#: Texts that the contracts' boolean fields accept.
BOOLEAN_WORDS = ("0", "1", "f", "false", "n", "no", "off", "on", "t", "true", "y", "yes")


def first_reason(*rules: tuple[Column, str | Column]) -> Column:
    """Text of the first failing rule (``rule`` is TRUE when it fails)."""
    out = F.lit(None).cast("string")
    for cond, text in reversed(rules):
        out = F.when(cond, text if isinstance(text, Column) else F.lit(text)).otherwise(out)
    return out


def _keys(raw: Column) -> Column:
    return F.json_object_keys(raw)


def _has(raw: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(_keys(raw), key), F.lit(False))


def _is_object(raw: Column) -> Column:
    return _keys(raw).isNotNull()


def _decimal(text: Column) -> Column:
    return F.when(text.rlike(DECIMAL_RE), text.try_cast(PRICE_TYPE))


def _kind(doc: Column, field: str) -> Column:
    """Type of a top-level JSON field (STRING, BOOLEAN, BIGINT, DECIMAL(..), VOID, ...); NULL if it is not there."""
    return F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), f"$.{field}", "variant"))


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE)")


def _truthy(kind: Column, text: Column) -> Column:
    """Python truthiness of a JSON value: a text is true unless it is empty,
    a number unless it is 0, a container unless it is empty."""
    return (F.when(kind == "STRING", F.length(text) > 0)
            .when(kind == "BOOLEAN", text == "true")
            .when(_is_number(kind), F.coalesce(text.try_cast("double") != 0, F.lit(True)))
            .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), ~text.rlike(r"^[\[{]\s*[\]}]$"))
            .otherwise(F.lit(False)))


SRC_BINANCE, SRC_KRAKEN, SRC_COINGECKO, SRC_CRYPTOCOMPARE = (
    "binance.trades", "kraken.depth", "coingecko.rest", "cryptocompare.rest")


def _g(guard: Column | None) -> Column:
    return F.lit(True) if guard is None else guard


def _binance_prep(d: DataFrame, guard: Column | None = None) -> DataFrame:
    guard, raw = _g(guard), F.col("raw")
    d = computed_once(d, _names=F.when(guard, _keys(raw)))
    is_object = F.col("_names").isNotNull()  # a failed parse is dear, so each bad document fails one only
    return computed_once(d, _b=F.when(is_object, F.from_json(raw, "t string, E string, p string, q string, m string")),
                         _m_kind=F.when(is_object, _kind(raw, "m")))


def _binance_fields(symbol: str) -> dict:
    names = F.col("_names")
    fail = [(names.isNull(), F.lit(f"{REASON_SCHEMA}:not a JSON object"))]
    fail += [(~F.coalesce(F.array_contains(names, k), F.lit(False)), F.lit(f"{REASON_SCHEMA}:missing field {k}"))
             for k in ("t", "E", "p", "q", "m")]
    fail += [(~F.coalesce(F.col("_b.E").rlike(INT_RE), F.lit(False)), f"{REASON_SCHEMA}:event time is not an integer"),
             (_decimal(F.col("_b.p")).isNull(), f"{REASON_SCHEMA}:invalid decimal price"),
             (_decimal(F.col("_b.q")).isNull(), f"{REASON_SCHEMA}:invalid decimal quantity")]
    return {"venue": F.lit("binance"), "symbol": F.lit(symbol),
            "trade_id": F.coalesce(F.col("_b.t"), F.lit("None")),
            "event_ts_ms": F.col("_b.E").try_cast("bigint"),
            "price": _decimal(F.col("_b.p")), "quantity": _decimal(F.col("_b.q")),
            "is_buyer_maker": _truthy(F.col("_m_kind"), F.col("_b.m")), "reason": first_reason(*fail)}


def _apply(d: DataFrame, fields: dict, drop: list[str]) -> DataFrame:
    return computed_once(d, **fields).drop(*drop)


def normalise_binance(msgs: DataFrame, symbol: str = "BTCUSDT") -> DataFrame:
    """Binance trade stream message -> trade event + reason."""
    return _apply(_binance_prep(msgs), _binance_fields(symbol), ["_b", "_names", "_m_kind"])


def _levels(text: Column) -> Column:
    """JSON list of ``[price, qty, ...]`` lists -> array<struct<price,qty>>."""
    arr = F.from_json(text, "array<array<string>>")
    return F.transform(arr, lambda lv: F.struct(
        F.when(F.size(lv) >= 2, _decimal(lv[0])).alias("price"),
        F.when(F.size(lv) >= 2, _decimal(lv[1])).alias("qty")))


def _last_value(objs: Column, key: str) -> Column:
    """Value of ``key`` in the last object element that has it (dict.update order)."""
    vals = F.filter(F.transform(objs, lambda o: F.get_json_object(o, f"$.{key}")), lambda v: v.isNotNull())
    return F.try_element_at(vals, F.lit(-1))


def _kraken_prep(d: DataFrame, guard: Column | None = None) -> DataFrame:
    guard = _g(guard)
    raw = F.col("raw")
    d = computed_once(d, _elems=F.when(guard, F.from_json(raw, "array<string>")))
    skip = (F.col("_elems").isNotNull() & (F.size("_elems") < 2)) | (F.col("_elems").isNull() & _is_object(raw))
    d = d.filter(~(guard & skip))
    d = computed_once(d, _objs=F.when(guard, F.filter(F.col("_elems"), lambda e: e.startswith("{"))))
    d = computed_once(d, _new_bids=_levels(_last_value(F.col("_objs"), "b")), _new_asks=_levels(_last_value(F.col("_objs"), "a")))
    b, bs = F.col("_new_bids"), _levels(_last_value(F.col("_objs"), "bs"))
    a, as_ = F.col("_new_asks"), _levels(_last_value(F.col("_objs"), "as"))
    empty = F.array().cast("array<struct<price:decimal(38,9),qty:decimal(38,9)>>")
    bids = F.when(F.size(F.coalesce(b, empty)) > 0, b).otherwise(F.coalesce(bs, empty))
    asks = F.when(F.size(F.coalesce(a, empty)) > 0, a).otherwise(F.coalesce(as_, empty))
    return computed_once(d, _bids=F.when(guard, bids), _asks=F.when(guard, asks)).drop("_new_bids", "_new_asks")


def _kraken_fields(pair: str) -> dict:
    bad_level = lambda c: F.exists(F.col(c), lambda lv: lv["price"].isNull() | lv["qty"].isNull())
    ms = F.unix_millis(F.col("recv_ts"))
    return {"venue": F.lit("kraken"), "symbol": F.lit(pair), "update_id": ms.cast("string"), "event_ts_ms": ms,
            "bids": F.col("_bids"), "asks": F.col("_asks"),
            "reason": first_reason((F.col("_elems").isNull(), f"{REASON_SCHEMA}:not a JSON array"),
                                   (bad_level("_bids") | bad_level("_asks"), f"{REASON_SCHEMA}:invalid book level"))}


def normalise_kraken(msgs: DataFrame, pair: str = "XBT/USDT") -> DataFrame:
    """Kraken book message -> order-book event + reason.

    Objects (control messages) and arrays shorter than 2 are skipped (no
    event, no dead letter).  Object elements are merged (later wins); bids =
    ``b`` if non-empty else ``bs``; asks = ``a`` else ``as``.  Update id and
    event time are the receive time in ms.
    """
    return _apply(_kraken_prep(msgs), _kraken_fields(pair), ["_elems", "_objs", "_bids", "_asks"])


def coin_symbol(coin_id) -> Column:
    """Known ids map to tickers; others upper-case, '-' -> '_', 32 chars."""
    c = F.col(coin_id) if isinstance(coin_id, str) else coin_id
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in COIN_SYMBOLS.items()))
    return F.coalesce(lookup[F.lower(c)], F.substring(F.upper(F.regexp_replace(c, "-", "_")), 1, COIN_SYMBOL_MAX_LEN))


def _quote_id(prefix: str) -> Column:
    # The producer uses a random suffix; a hash of the message keeps replays idempotent.
    ms = F.unix_millis(F.col("recv_ts")).cast("string")
    return F.concat(F.lit(prefix + "-"), ms, F.lit("-"),
                    F.substring(F.sha2(F.concat_ws("|", F.col("raw"), ms), 256), 1, 8))


def _coingecko_prep(d: DataFrame, coin_id, guard: Column | None = None) -> DataFrame:
    guard = _g(guard)
    if isinstance(coin_id, str):
        coin = F.col(coin_id) if coin_id in d.columns else F.lit(coin_id)
    else:
        coin = coin_id
    # raw.get(coin) or raw.get(coin.lower())
    inner = F.coalesce(F.expr("get_json_object(raw, concat('$[\\'', _coin, '\\']'))"),
                       F.expr("get_json_object(raw, concat('$[\\'', lower(_coin), '\\']'))"))
    return computed_once(d.withColumn("_coin", F.when(guard, coin)), _inner=F.when(guard, inner))


def _coingecko_fields() -> dict:
    usd = F.when(F.col("_inner").startswith("{"), F.get_json_object("_inner", "$.usd"))
    keys = F.array_join(F.coalesce(_keys(F.col("raw")), F.array().cast("array<string>")), ", ")
    return {"venue": F.lit("coingecko"), "symbol": coin_symbol(F.col("_coin")), "quote_id": _quote_id("cg"),
            "event_ts_ms": F.unix_millis(F.col("recv_ts")), "price_usd": _decimal(usd),
            "reason": first_reason((usd.isNull(), F.concat(F.lit(f"{REASON_POLL}:unexpected coingecko payload keys=["),
                                                           keys, F.lit("]"))),
                                   (_decimal(usd).isNull(), f"{REASON_POLL}:invalid decimal price"))}


def normalise_coingecko(msgs: DataFrame, coin_id: str | Column = "coin_id") -> DataFrame:
    """``{"<coin>": {"usd": n}}`` -> quote; no usd -> poll_failed reject."""
    return _apply(_coingecko_prep(msgs, coin_id), _coingecko_fields(), ["_coin", "_inner"])


def _cryptocompare_fields(fsym: str) -> dict:
    usd = F.get_json_object("raw", "$.USD")
    return {"venue": F.lit("cryptocompare"), "symbol": F.lit(fsym.upper()), "quote_id": _quote_id("cc"),
            "event_ts_ms": F.unix_millis(F.col("recv_ts")), "price_usd": _decimal(usd),
            "reason": first_reason((usd.isNull(), F.concat(F.lit(f"{REASON_POLL}:unexpected cryptocompare payload: "),
                                                           F.col("raw"))),
                                   (_decimal(usd).isNull(), f"{REASON_POLL}:invalid decimal price"))}


def normalise_cryptocompare(msgs: DataFrame, fsym: str = "BTC") -> DataFrame:
    """``{"USD": n}`` -> quote for ``fsym``; no USD -> poll_failed reject."""
    return _apply(msgs, _cryptocompare_fields(fsym), [])


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def event_json(kind: str) -> Column:
    """Contract JSON of a normalised event (decimals as strings, like the producer)."""
    ingest = _iso(F.col("recv_ts")).alias("ingest_ts")
    if kind == "trade":
        return F.to_json(F.struct(
            "venue", "symbol", "trade_id", "event_ts_ms", F.col("price").cast("string").alias("price"),
            F.col("quantity").cast("string").alias("quantity"), "is_buyer_maker", ingest,
            F.parse_json(F.col("raw")).alias("raw_event")))
    if kind == "depth":
        lv = lambda c: F.transform(F.col(c), lambda x: F.struct(
            x["price"].cast("string").alias("price"), x["qty"].cast("string").alias("qty")))
        return F.to_json(F.struct("venue", "symbol", "update_id", "event_ts_ms", lv("bids").alias("bids"),
                                  lv("asks").alias("asks"), ingest,
                                  F.struct(F.parse_json(F.col("raw")).alias("message")).alias("raw_event")))
    return F.to_json(F.struct("venue", "symbol", "quote_id", "event_ts_ms",
                              F.col("price_usd").cast("string").alias("price_usd"), ingest,
                              F.parse_json(F.col("raw")).alias("raw_event")))


def dlq_envelope(source: Column | str) -> Column:
    """C4: ``{source, reason, raw_payload, ingest_ts}`` (receive time)."""
    src = F.col(source) if isinstance(source, str) else source
    return F.to_json(F.struct(src.alias("source"), F.col("reason").alias("reason"),
                              F.col("raw").alias("raw_payload"), _iso(F.col("recv_ts")).alias("ingest_ts")))


def route(normalised: DataFrame, kind: str, topic: str) -> DataFrame:
    """One pass -> Kafka rows; valid events to ``topic`` keyed
    ``venue:symbol``, rejects to the DLQ topic keyed by source."""
    ok = F.col("reason").isNull()
    return normalised.select(
        F.when(ok, F.lit(topic)).otherwise(F.lit(TOPIC_DLQ)).alias("topic"),
        F.when(ok, F.concat_ws(":", "venue", "symbol")).otherwise(F.col("source")).alias("key"),
        F.when(ok, event_json(kind)).otherwise(dlq_envelope("source")).alias("value"),
        "source", "reason", "recv_ts", "recv_seq")


def split(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) views of one routed frame."""
    return routed.filter(F.col("reason").isNull()), routed.filter(F.col("reason").isNotNull())


def normalise_all(msgs: DataFrame, binance_symbol: str = "BTCUSDT", kraken_pair: str = "XBT/USDT",
                  coin_id="coin_id", fsym: str = "BTC") -> DataFrame:
    """Every source of a message table -> routed Kafka rows in ONE pass.

    Each field is a CASE on ``source`` and each parse is guarded by its
    source, so a row only runs its own normaliser; the capture is scanned
    once.  A filter on the routed rows stays above the normalisers: pushed
    into them it would repeat each parse for every use.  Rows of unknown (or no) source go to the dead-letter topic.
    """
    src = F.col("source")
    guards = {SRC_BINANCE: src == SRC_BINANCE, SRC_KRAKEN: src == SRC_KRAKEN,
              SRC_COINGECKO: src == SRC_COINGECKO, SRC_CRYPTOCOMPARE: src == SRC_CRYPTOCOMPARE}
    guards = {k: F.coalesce(g, F.lit(False)) for k, g in guards.items()}
    d = _binance_prep(msgs, guards[SRC_BINANCE])
    d = _kraken_prep(d, guards[SRC_KRAKEN])
    d = _coingecko_prep(d, coin_id, guards[SRC_COINGECKO])
    per_source = [(guards[SRC_BINANCE], _binance_fields(binance_symbol)),
                  (guards[SRC_KRAKEN], _kraken_fields(kraken_pair)),
                  (guards[SRC_COINGECKO], _coingecko_fields()),
                  (guards[SRC_CRYPTOCOMPARE], _cryptocompare_fields(fsym))]
    names: list[str] = []
    for _, f in per_source:
        names += [n for n in f if n not in names]
    cols = {}
    for n in names:
        c = None
        for g, f in per_source:
            if n in f:
                c = F.when(g, f[n]) if c is None else c.when(g, f[n])
        if n == "reason":
            c = c.otherwise(F.lit(f"{REASON_SCHEMA}:unknown source"))
        cols[n] = c
    d = computed_once(d, **cols)
    ok = F.col("reason").isNull()
    g = guards
    topic = (F.when(g[SRC_BINANCE], F.lit(TOPIC_TRADES)).when(g[SRC_KRAKEN], F.lit(TOPIC_DEPTH))
             .when(g[SRC_COINGECKO], F.lit(TOPIC_COINGECKO)).otherwise(F.lit(TOPIC_CRYPTOCOMPARE)))
    event = (F.when(g[SRC_BINANCE], event_json("trade")).when(g[SRC_KRAKEN], event_json("depth"))
             .otherwise(event_json("quote")))
    return d.select(
        F.when(ok, topic).otherwise(F.lit(TOPIC_DLQ)).alias("topic"),
        F.when(ok, F.concat_ws(":", "venue", "symbol")).otherwise(F.coalesce("source", F.lit(UNKNOWN))).alias("key"),
        F.when(ok, event).otherwise(dlq_envelope(F.coalesce("source", F.lit(UNKNOWN)))).alias("value"),
        "source", "reason", "recv_ts", "recv_seq")


# --- contract checks on published events (C1-C3) -----------------------------

def _contract(doc: Column, fields: list[str], rules: list[tuple[Column, str]]) -> Column:
    extra = F.array_except(F.coalesce(_keys(doc), F.array().cast("array<string>")),
                           F.array(*[F.lit(f) for f in fields]))
    base = [(~_is_object(doc), f"{REASON_SCHEMA}:not a JSON object"),
            (F.size(extra) > 0, F.concat(F.lit(f"{REASON_SCHEMA}:extra fields "), F.array_join(extra, ",")))]
    base += [(~_has(doc, f), f"{REASON_SCHEMA}:missing field {f}") for f in fields]
    last = [_time(doc, "ingest_ts"), _object(doc, "raw_event")]
    return first_reason(*(base + rules + last))


def _nonempty(doc, f):
    v = F.get_json_object(doc, f"$.{f}")
    return (v.isNull() | (F.length(v) == 0), f"{REASON_SCHEMA}:{f} must be a non-empty string")


def _int(doc, f):
    v = F.get_json_object(doc, f"$.{f}")
    return (~F.coalesce(v.rlike(INT_RE), F.lit(False)), f"{REASON_SCHEMA}:{f} must be an integer")


def _dec(doc, f):
    v = F.get_json_object(doc, f"$.{f}")
    return (_decimal(v).isNull(), f"{REASON_SCHEMA}:{f} must be a decimal")


def _bool(doc, f):
    """What a non-strict boolean field accepts: a JSON boolean, the numbers 0
    and 1, and the usual words in any case."""
    v, kind = F.get_json_object(doc, f"$.{f}"), _kind(doc, f)
    ok = (F.when(kind == "BOOLEAN", F.lit(True))
          .when(kind == "STRING", F.lower(v).isin(*BOOLEAN_WORDS))
          .when(_is_number(kind), v.try_cast("double").isin(0.0, 1.0)))
    return (~F.coalesce(ok, F.lit(False)), f"{REASON_SCHEMA}:{f} must be a boolean")


def _time(doc, f):
    """A date-time text in ISO form, or a number of seconds since 1970."""
    v, kind = F.get_json_object(doc, f"$.{f}"), _kind(doc, f)
    ok = F.when(kind == "STRING", v.try_cast("timestamp").isNotNull()).when(_is_number(kind), F.lit(True))
    return (~F.coalesce(ok, F.lit(False)), f"{REASON_SCHEMA}:{f} must be a date-time")


def _object(doc, f):
    return (~F.coalesce(_kind(doc, f).startswith("OBJECT"), F.lit(False)), f"{REASON_SCHEMA}:{f} must be an object")


def check_trade(doc) -> Column:
    """Trade contract (non-empty ids, integer time, decimal price and
    quantity, JSON boolean flag, no extra keys)."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return _contract(d, TRADE_FIELDS, [_nonempty(d, "venue"), _nonempty(d, "symbol"), _nonempty(d, "trade_id"),
                                       _int(d, "event_ts_ms"), _dec(d, "price"), _dec(d, "quantity"),
                                       _bool(d, "is_buyer_maker")])


def check_book(doc) -> Column:
    """Book contract; levels need decimal price and qty, lists may be empty."""
    d = F.col(doc) if isinstance(doc, str) else doc
    lv = "array<struct<price:string,qty:string>>"
    bad = lambda side: F.coalesce(F.exists(F.from_json(F.get_json_object(d, f"$.{side}"), lv),
                                           lambda x: _decimal(x["price"]).isNull() | _decimal(x["qty"]).isNull()),
                                  F.lit(True))
    return _contract(d, BOOK_FIELDS, [_nonempty(d, "venue"), _nonempty(d, "symbol"), _nonempty(d, "update_id"),
                                      _int(d, "event_ts_ms"), (bad("bids"), f"{REASON_SCHEMA}:invalid bids"),
                                      (bad("asks"), f"{REASON_SCHEMA}:invalid asks")])


def check_quote(doc) -> Column:
    """REST quote contract."""
    d = F.col(doc) if isinstance(doc, str) else doc
    return _contract(d, QUOTE_FIELDS, [_nonempty(d, "venue"), _nonempty(d, "symbol"), _nonempty(d, "quote_id"),
                                       _int(d, "event_ts_ms"), _dec(d, "price_usd")])
