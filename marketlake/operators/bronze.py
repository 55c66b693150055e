"""Bronze projection (B1-B7): Kafka-shaped records -> bronze rows.

Stateless and row-local: works the same on a batch DataFrame and on a
stream, and never shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import path_safe, with_json_fields
from marketlake.schemas import BRONZE_COLUMNS, TOPIC_KIND, UNKNOWN


def stream_kind(topic="topic"):
    """B1: topic -> stream kind through a literal map (NULL for other topics)."""
    lookup = F.create_map(*chain.from_iterable((F.lit(t), F.lit(k)) for t, k in TOPIC_KIND.items()))
    return lookup[F.col(topic)]


def to_bronze(records: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """B1-B7 over one multi-topic record set (the union is the subscription).

    Input columns: ``value`` (JSON text), ``topic``, ``partition``,
    ``offset``, ``timestamp``.  Output: the 11 bronze columns, and a column
    ``_j_<field>`` with the scalar text of each payload field named in
    ``also``: staging right behind takes these instead of a second parse.
    """
    # one JSON parse per message for all top-level fields
    fields = list(dict.fromkeys(["venue", "symbol", "event_ts_ms", "ingest_ts", *also]))
    j = {f: F.col("_j_" + f) for f in fields}
    ms = j["event_ts_ms"].try_cast("bigint")
    return with_json_fields(records, "value", fields).select(
        stream_kind("topic").alias("stream_kind"),
        F.col("value").alias("payload"),
        F.coalesce(j["venue"], F.lit(UNKNOWN)).alias("exchange"),
        path_safe(j["symbol"]).alias("symbol"),
        ms.alias("event_ts_ms"),
        j["ingest_ts"].alias("ingest_ts"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_ts"),
        F.date_format(F.coalesce(F.timestamp_millis(ms), F.col("timestamp")), "yyyy-MM-dd").alias("dt"),
        *[j[f] for f in also],
    ).select(*BRONZE_COLUMNS, *["_j_" + f for f in also])


def drop_required_nulls(bronze: DataFrame, required: list[str] | None = None) -> DataFrame:
    """K5: drop rows violating NOT NULL columns (none are declared by default)."""
    return bronze.dropna(subset=required) if required else bronze
