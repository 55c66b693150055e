"""The market pipeline wired end to end on the driver's tables.

``bronze -> stg_trades / stg_depth -> candles / depth / dlq roll-ups -> gold``.
Each step is a lazy DataFrame; ``build_all`` materialises bronze, silver and
gold tables under one base path (as the warehouse layers would).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketlake.operators.bronze import to_bronze
from marketlake.operators.candles import candles, depth_bars, dlq_bars
from marketlake.operators.staging import stg_depth, stg_trades
from marketlake.plans.gold import gold_from_bars, write_gold
from marketlake.session import ensure_conf
from marketlake.sources.adapters import events_as_kafka, lineitem_as_kafka
from marketlake.sources.bronze import read_bronze, write_bronze_batch
from marketlake.sources.silver import read_silver, write_silver


def events_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_conf(spark)
    return to_bronze(events_as_kafka(spark, sf_dir))


def lineitem_bronze(spark: SparkSession, sf_dir: str, also: Sequence[str] = ()) -> DataFrame:
    ensure_conf(spark)
    return to_bronze(lineitem_as_kafka(spark, sf_dir), also)


@dataclass(frozen=True)
class Layout:
    """Where each layer lives (bronze / silver / gold datasets)."""
    base: str
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{getattr(self, layer)}/{name}"


def build_all(spark: SparkSession, bronze: DataFrame, layout: Layout, bucket: str = "minute") -> dict:
    """Materialise silver tables and the gold mart from a bronze DataFrame.

    Staged trades feed both candles and gold, so they are written once and
    read back (a durable cut of lineage that survives executor loss) rather
    than recomputed or cached in executor memory.  Every table is replaced as
    a whole, so a second run gives the same tables.
    """
    bpath = layout.path("bronze", "market")
    write_bronze_batch(bronze, bpath, mode="overwrite")
    b = read_bronze(spark, bpath)
    tpath, dpath = layout.path("silver", "stg_trades"), layout.path("silver", "stg_depth")
    write_silver(stg_trades(b), tpath, mode="overwrite")
    write_silver(stg_depth(b), dpath, mode="overwrite")
    t, d = read_silver(spark, tpath), read_silver(spark, dpath)
    out = {"bronze": bpath, "stg_trades": tpath, "stg_depth": dpath}
    for name, df in (("int_ohlcv_1m", candles(t, bucket)), ("int_depth_1m", depth_bars(d, bucket)),
                     ("int_dlq_1m", dlq_bars(b, bucket))):
        p = layout.path("silver", name)
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(p)
        out[name] = p
    g = layout.path("gold", "fct_market_metrics")
    # the bars as just written, so they are computed once
    bars = [spark.read.parquet(out[n]) for n in ("int_ohlcv_1m", "int_depth_1m", "int_dlq_1m")]
    rolling = ("rolling_avg_close_5m", "zero_volume_flag", "price_spike_flag", "anomaly_flag")  # gold's series window makes these
    write_gold(gold_from_bars(bars[0].drop(*rolling), *bars[1:]), g)
    out["fct_market_metrics"] = g
    return out
