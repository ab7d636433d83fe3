"""Kafka as a source and sink. Needs the spark-sql-kafka package on the cluster."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventbase.sources.envelope import decode

# Fixed value: how often a failed fetch of offsets is tried again.
FETCH_RETRIES = 3


def parse_offsets(text: str) -> dict[int, int]:
    """``"0:120,1:98"`` -> ``{0: 120, 1: 98}``."""
    pairs = (item.split(":") for item in text.split(",") if item.strip())
    return {int(partition): int(offset) for partition, offset in pairs}


def starting_offsets(topic: str, saved: str | None) -> str:
    """The ``startingOffsets`` option: saved positions when there are any, else the latest."""
    if not saved:
        return "latest"
    return json.dumps({topic: {str(p): o for p, o in sorted(parse_offsets(saved).items())}})


def offsets_text(partition: Column, offset: Column) -> Column:
    """Aggregate: positions rendered as ``partition:offset,...`` (one entry per partition)."""
    rendered = F.sort_array(F.collect_set(F.struct(partition.alias("p"), offset.alias("o"))))
    return F.array_join(
        F.transform(rendered, lambda x: F.concat_ws(":", x["p"].cast("string"), x["o"].cast("string"))), ","
    )


def kafka_options(
    brokers: str,
    topic: str,
    *,
    saved_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of the stream reader.

    Saved offsets only seed a first run: afterwards the checkpoint decides. A topic whose
    messages all share one key has one partition; ``min_partitions`` splits it by offset
    range so that parsing is not tied to that number.
    """
    if not brokers or not topic:
        raise ValueError("brokers and topic are required")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets(topic, saved_offsets),
        "fetchOffset.numRetries": str(FETCH_RETRIES),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return {**options, **extra}


def stream_kafka(spark: SparkSession, brokers: str, topic: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, **options))
    return decode(reader.load())


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    """Send (key, value) messages; the key decides the partition, so its order is kept."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )
