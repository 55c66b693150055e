"""Streams with keyed state: best delivery per trade (Z3), and rolling values over traded buckets.

* ``stream_best_trades`` holds the best delivery of each trade until the watermark has passed its last one by ``gap``. The state is that
  of a session window per trade: a struct of the row under the order that the batch dedup uses, and a timer at the session's end. It
  stays in the JVM and in the state store; nothing is compared in Python.
* ``stream_rolling`` holds, per series, a ring of its last traded buckets. Bars may come in any order: each one recomputes the values
  of the buckets that it can change (those after it, as far as the windows reach) and sends them again with a higher revision.
  ``latest_rolling`` keeps the last one. A bar older than the ring is passed on as ``too_late`` for the batch repair (Z7).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from marketlake.operators.staging import parse_trades, valid_trade
from marketlake.schemas import PRICE_SPIKE_THRESHOLD, ROLLING_CLOSE_ROWS, SERIES_KEYS, STG_TRADES_COLUMNS, VOLATILITY_LONG_ROWS, VOLATILITY_ROWS

TRADE_KEYS = [*SERIES_KEYS, "trade_id"]


def stream_best_trades(bronze: DataFrame, watermark: str = "10 minutes", gap: str = "10 minutes") -> DataFrame:
    """Z3 (T7, T8): staged trades, of each the delivery with the highest offset, partition and topic, then the latest ingest.

    Deliveries of a trade whose event times lie within ``gap`` of each other are one trade; it is emitted once the watermark has
    passed the last of them by ``gap``. Equal to the batch result as long as replays come within that time and one Kafka identity
    carries one trade; later ones are the batch repair's. Rows without Kafka identity are kept apart by trade (the batch keeps one of all).
    """
    t = parse_trades(bronze).withWatermark("event_ts", watermark).filter(valid_trade())
    order = F.struct("kafka_offset", "kafka_partition", "kafka_topic", "ingest_ts", "event_ts")
    best = F.max_by(F.struct(*STG_TRADES_COLUMNS), order).alias("best")
    return t.groupBy(*TRADE_KEYS, F.session_window("event_ts", gap).alias("session")).agg(best).select("best.*")


def open_trades(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The trades that a stopped stream of best trades still holds, read from its state store."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("value.valueWithExtremumOrdering.*").select(*STG_TRADES_COLUMNS)


def last_watermark(spark: SparkSession, checkpoint: str) -> int:
    """The last watermark (milliseconds) that a stream's batches were planned with; 0 if it had none yet."""
    lines = spark.read.text(f"{checkpoint}/offsets").filter(F.col("value").contains("batchWatermarkMs"))
    found = lines.select(F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("ms"))
    return found.agg(F.max("ms")).first()[0] or 0


ROLLING = ("exchange string, symbol string, metric_ts timestamp, close_price decimal(38,9), rolling_avg_close_5m double, log_close_return double, "
           "volatility double, volatility_60m double, zero_volume_flag boolean, price_spike_flag boolean, anomaly_flag boolean, "
           "revision bigint, too_late boolean")
RING = "ts array<bigint>, close array<decimal(38,9)>, volume array<decimal(38,9)>, revision bigint, cut bigint"
#: Buckets whose values a bar reaches: its own return and the next one's, each in VOLATILITY_LONG_ROWS windows.
REACH = VOLATILITY_LONG_ROWS


def log_returns(close: list[Decimal]) -> np.ndarray:
    """ln(close / previous close), NaN where there is none or it isn't positive."""
    out = np.full(len(close), np.nan)
    for k in range(1, len(close)):
        if close[k] is not None and close[k - 1]:
            ratio = float(close[k]) / float(close[k - 1])
            out[k] = np.log(ratio) if ratio > 0 else np.nan
    return out


def _sample_std(values: np.ndarray) -> float | None:
    values = values[~np.isnan(values)]
    return float(np.std(values, ddof=1)) if len(values) > 1 else None


def rolling_rows(ts: list[int], close: list[Decimal], volume: list[Decimal], first: int) -> list[tuple]:
    """The rolling values of the buckets from index ``first`` on, over all buckets of a series that are given (in order of time)."""
    moves, out = log_returns(close), []
    for k in range(first, len(ts)):
        five = [c for c in close[max(0, k + 1 - ROLLING_CLOSE_ROWS) : k + 1] if c is not None]
        with localcontext(prec=60):
            mean = sum(five, Decimal(0)) / len(five) if five else None
            off = None if mean is None or close[k] is None else float(close[k] - mean)
        zero = volume[k] is not None and volume[k] == 0
        spike = bool(mean) and off is not None and abs(off / float(mean)) > PRICE_SPIKE_THRESHOLD
        out.append((
            pd.Timestamp(ts[k], unit="us"), close[k], None if mean is None else float(mean), None if np.isnan(moves[k]) else float(moves[k]),
            _sample_std(moves[max(0, k + 1 - VOLATILITY_ROWS) : k + 1]), _sample_std(moves[max(0, k + 1 - VOLATILITY_LONG_ROWS) : k + 1]),
            zero, spike, zero or spike))
    return out


def _ring(keep: int):
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ts, close, volume, revision, cut = state.get if state.exists else ([], [], [], 0, -(2**62))
        held = {t: (c, v) for t, c, v in zip(ts, close, volume, strict=True)}
        late, changed = [], None
        for frame in frames:
            stamps = frame["metric_ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
            for t, c, v in zip(stamps.tolist(), frame["close_price"], frame["base_volume"], strict=True):
                if t <= cut:
                    late.append((t, c))
                else:
                    held[t] = (c, v)
                    changed = t if changed is None else min(changed, t)
        out, revision = [], revision + 1
        if changed is not None:
            ts = sorted(held)
            close, volume = [held[t][0] for t in ts], [held[t][1] for t in ts]
            # the oldest buckets of a full ring are there for the windows only: their own values can't be recomputed
            out = [(*key, *row, revision, False) for row in rolling_rows(ts, close, volume, ts.index(changed))]
            if len(ts) > keep:
                cut = ts[len(ts) - keep + REACH - 1] if keep > REACH else ts[-1]
                ts, close, volume = ts[-keep:], close[-keep:], volume[-keep:]
            state.update((ts, close, volume, revision, cut))
        out += [(*key, pd.Timestamp(t, unit="us"), c, *[None] * 4, None, None, None, revision, True) for t, c in late]
        names = [c.split()[0] for c in ROLLING.split(", ")]
        yield pd.DataFrame(out, columns=names)

    return advance


def stream_rolling(bars: DataFrame, keep: int = 1440) -> DataFrame:
    """W1-W5, G1-G3 on a stream of closed bars (``candle_bars`` columns), in any order within the last ``keep`` buckets of a series.

    State per series: ``keep`` buckets of time, close and volume. A bar that comes in order is one row of output; a late one is one for
    each bucket from it to the newest, as every later window may hold its return.
    """
    if keep <= REACH:
        raise ValueError(f"keep must be above {REACH}, the buckets that the longest window needs")
    rows = bars.select(*SERIES_KEYS, "metric_ts", "close_price", "base_volume")
    return rows.groupBy(*SERIES_KEYS).applyInPandasWithState(_ring(keep), ROLLING, RING, "append", GroupStateTimeout.NoTimeout)


def latest_rolling(rolling: DataFrame) -> DataFrame:
    """The last revision of every bucket, without those that came too late."""
    columns = [c for c in rolling.columns if c not in ("revision", "too_late", *SERIES_KEYS, "metric_ts")]
    last = rolling.filter(~F.col("too_late")).groupBy(*SERIES_KEYS, "metric_ts").agg(F.max_by(F.struct(*columns), "revision").alias("v"))
    return last.select(*SERIES_KEYS, "metric_ts", "v.*")


def too_late(rolling: DataFrame) -> DataFrame:
    """Bars that were older than the ring when they came; ``repair_days`` is for them."""
    return rolling.filter("too_late").select(*SERIES_KEYS, "metric_ts", "close_price")
