"""Kafka source and sink options.

The Kafka connector is a runtime package (``spark-sql-kafka``); these
helpers only build options and projections, so they are usable (and
testable) without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import venue_symbol_key
from marketlake.schemas import TOPIC_KIND


def source_options(bootstrap: str, topics=None, starting_offsets: str = "earliest",
                   group_id_prefix: str = "marketlake-bronze", min_partitions: int | None = None,
                   max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> dict:
    """One multi-topic subscription (the union of the four raw
    topics plus the dead-letter topic), earliest start, progress kept in the
    query checkpoint (the group id only names the consumer).  Records that
    the topic's retention removed before they were read fail the query,
    unless ``fail_on_data_loss`` is switched off."""
    topics = list(topics or TOPIC_KIND.keys())
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topics),
            "startingOffsets": starting_offsets, "groupIdPrefix": group_id_prefix,
            "failOnDataLoss": str(fail_on_data_loss).lower(), "includeHeaders": "false"}
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def records(raw: DataFrame) -> DataFrame:
    """Kafka rows -> (key, value, topic, partition, offset, timestamp) text."""
    return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      "topic", "partition", "offset", "timestamp")


def read_stream(spark: SparkSession, opts: dict) -> DataFrame:
    return records(spark.readStream.format("kafka").options(**opts).load())


def read_batch(spark: SparkSession, opts: dict, ending_offsets: str = "latest") -> DataFrame:
    o = dict(opts)
    o.pop("groupIdPrefix", None)
    o["endingOffsets"] = ending_offsets
    return records(spark.read.format("kafka").options(**o).load())


def sink_options(bootstrap: str, acks: str = "all", compression: str = "gzip", linger_ms: int = 10) -> dict:
    """K6: producer settings (all replicas ack, gzip batches, 10 ms linger)."""
    return {"kafka.bootstrap.servers": bootstrap, "kafka.acks": acks, "kafka.compression.type": compression,
            "kafka.linger.ms": str(linger_ms)}


def to_kafka_rows(events: DataFrame, topic: str, key_cols=("venue", "symbol")) -> DataFrame:
    """K6: ``key = venue:symbol``, ``value = compact JSON of the event``."""
    return events.select(venue_symbol_key(*key_cols).alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"),
                         F.lit(topic).alias("topic"))


def write_routed(routed: DataFrame, options: dict, fmt: str = "kafka") -> None:
    """K6/K7: publish routed rows (valid events and dead letters alike) to the
    topic that each row names."""
    routed.select("key", "value", "topic").write.format(fmt).mode("append").options(**options).save()


def start_routed_writer(routed: DataFrame, options: dict, checkpoint: str, fmt: str = "kafka", path: str | None = None,
                        available_now: bool = False, trigger_seconds: int = 10):
    """K6/K7 as a stream.  A file format (with ``path``) stands in for the
    broker: one folder per topic."""
    w = (routed.select("key", "value", "topic").writeStream.format(fmt).outputMode("append")
         .options(**options).option("checkpointLocation", checkpoint))
    if fmt != "kafka":
        w = w.partitionBy("topic")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(path) if path else w.start()
