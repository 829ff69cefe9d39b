"""Log sources: Kafka when deployed, else a Parquet log table of the same shape."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOG_SCHEMA


def kafka_options(config: dict[str, str]) -> dict[str, str]:
    """Pass-through of ``kafka.``-prefixed settings to Spark's Kafka source."""
    return {k: v for k, v in config.items() if k.startswith("kafka.")}


# Client settings that only consumers have.  Every other kafka.*
# setting goes to the producer too, so a setting that is new to the client
# isn't lost.
CONSUMER_ONLY = {
    "allow.auto.create.topics", "auto.commit.interval.ms", "auto.offset.reset", "check.crcs",
    "client.rack", "default.api.timeout.ms", "enable.auto.commit", "exclude.internal.topics",
    "fetch.max.bytes", "fetch.max.wait.ms", "fetch.min.bytes", "group.id", "group.instance.id",
    "group.protocol", "group.remote.assignor", "heartbeat.interval.ms", "isolation.level",
    "key.deserializer", "max.partition.fetch.bytes", "max.poll.interval.ms", "max.poll.records",
    "partition.assignment.strategy", "session.timeout.ms", "value.deserializer",
}


def producer_options(config: dict[str, str]) -> dict[str, str]:
    """Options for Spark's Kafka sink: ``kafka.*`` settings that aren't
    consumer-only, then ``producer.*`` settings on top (as ``kafka.*``)."""
    out = {k: v for k, v in config.items() if k.startswith("kafka.") and k[len("kafka."):] not in CONSUMER_ONLY}
    return out | {"kafka." + k[len("producer."):]: v for k, v in config.items() if k.startswith("producer.")}


# Spark Kafka source settings taken from the config when present.
SOURCE_OPTIONS = ("startingOffsets", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "minPartitions",
                  "failOnDataLoss", "groupIdPrefix")

# What one micro-batch of a Parquet log table takes at most: files, unless the
# config bounds files or bytes itself.
ADMISSION = ("maxFilesPerTrigger", "maxBytesPerTrigger")
MAX_FILES_PER_TRIGGER = "1000"


def admission(config: dict[str, str]) -> dict[str, str]:
    """What bounds a micro-batch of a log table."""
    return {k: str(config[k]) for k in ADMISSION if k in config} or {"maxFilesPerTrigger": MAX_FILES_PER_TRIGGER}


# Offsets that stand for a partition's first and next record.
EARLIEST, LATEST = -2, -1


def _bounds(text: str, what: str) -> dict[tuple[str, int], int]:
    """(topic, partition) -> offset of a JSON text such as {"messages": {"0": 23, "1": -2}}."""
    try:
        return {(topic, int(p)): int(offset) for topic, parts in json.loads(text).items() for p, offset in parts.items()}
    except (ValueError, AttributeError, TypeError) as e:
        raise ValueError(f"{what} is neither earliest, latest nor JSON of offsets by topic and partition: {text}") from e


def offset_range(config: dict[str, str], streaming: bool = False) -> Column | None:
    """The records of a log table between ``startingOffsets`` and ``endingOffsets`` (which isn't
    part of it), in the form that Spark's Kafka source takes; None if nothing is left out.

    Partitions that aren't named aren't bounded. The condition has one term for each
    range, over plain columns, so it reaches the Parquet scan; in a table laid out by
    partition and offset most row groups are never read.
    """
    start, end = config.get("startingOffsets", "earliest"), config.get("endingOffsets", "latest")
    if streaming and "endingOffsets" in config:
        raise ValueError("a stream has no endingOffsets")
    if start == "latest" and streaming:
        raise ValueError("a log table has no latest offset to start a stream from; name the offsets")
    if start == "latest" or end == "earliest":
        return F.lit(False)
    low = {} if start == "earliest" else _bounds(start, "startingOffsets")
    high = {} if end == "latest" else _bounds(end, "endingOffsets")
    ranges: dict[tuple[str, int | None, int | None], list[int]] = {}
    for topic, part in sorted(low.keys() | high.keys()):
        a, b = low.get((topic, part), EARLIEST), high.get((topic, part), LATEST)
        if a == LATEST and streaming:
            raise ValueError("a log table has no latest offset to start a stream from; name the offsets")
        if a == LATEST or b == EARLIEST:
            a, b = 0, 0
        ranges.setdefault((topic, None if a == EARLIEST else a, None if b == LATEST else b), []).append(part)
    if not ranges:
        return None
    topic, part, offset = F.col("topic"), F.col("partition"), F.col("offset")
    named: dict[str, list[int]] = {}
    inside = F.lit(False)
    for (t, a, b), parts in ranges.items():
        named.setdefault(t, []).extend(parts)
        term = (topic == t) & part.isin(parts)
        term = term if a is None else term & (offset >= a)
        inside = inside | (term if b is None else term & (offset < b))
    for t, parts in named.items():
        inside = inside | ((topic == t) & ~part.isin(parts))
    return inside | ~topic.isin(list(named))


def read_log(
    spark: SparkSession,
    config: dict[str, str] | None = None,
    path: str | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Kafka-shaped records: from Kafka when ``config`` names brokers and a
    topic, else from the Parquet log table at ``path``.  Every micro-batch of
    a stream is bounded: ``maxOffsetsPerTrigger`` for Kafka (as configured),
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` for a log table.
    ``startingOffsets`` and, for a batch read, ``endingOffsets`` hold for both."""
    config = config or {}
    if "bootstrap.servers" in config or "kafka.bootstrap.servers" in config:
        opts = {
            "kafka.bootstrap.servers": config.get("bootstrap.servers", config.get("kafka.bootstrap.servers")),
            "subscribe": config["topic"],
            "startingOffsets": "earliest",
            "includeHeaders": "true",
            **{k: config[k] for k in SOURCE_OPTIONS if k in config},
            **({"endingOffsets": config["endingOffsets"]} if "endingOffsets" in config and not streaming else {}),
            **kafka_options(config),
        }
        reader = spark.readStream if streaming else spark.read
        return reader.format("kafka").options(**opts).load()
    if path is None:
        raise ValueError("read_log needs Kafka settings or a log table path")
    wanted = offset_range(config, streaming)
    if streaming:
        log = spark.readStream.schema(LOG_SCHEMA).options(**admission(config)).parquet(path)
    else:
        log = spark.read.schema(LOG_SCHEMA).parquet(path)
    return log if wanted is None else log.where(wanted)


def write_log(
    records: DataFrame,
    config: dict[str, str] | None = None,
    path: str | None = None,
    by_offset: bool = False,
) -> None:
    """Publish Kafka-shaped records (value [, key, partition, headers]):
    to Kafka with the producer options derived from ``config`` when it names
    brokers, else appended to the Parquet log table at ``path``.  Values are
    written as given, so raw (non-Avro) bytes go out unencoded.  With
    ``by_offset`` the table's new files are ranges of (topic, partition, offset),
    each sorted, so that a read between offsets skips files and row groups."""
    config = config or {}
    if "bootstrap.servers" in config or "kafka.bootstrap.servers" in config:
        opts = producer_options(config)
        opts.setdefault("kafka.bootstrap.servers",
                        config.get("bootstrap.servers", config.get("kafka.bootstrap.servers")))
        cols = [c for c in ("key", "value", "topic", "partition", "headers") if c in records.columns]
        writer = records.select(*cols).write.format("kafka").options(**opts)
        if "topic" not in records.columns:
            writer = writer.option("topic", config["topic"])
        writer.save()
        return
    if path is None:
        raise ValueError("write_log needs Kafka settings or a log table path")
    full = records
    for f in LOG_SCHEMA.fields:
        if f.name not in full.columns:
            full = full.withColumn(f.name, F.lit(None).cast(f.dataType))
    full = full.select(*LOG_SCHEMA.names)
    if by_offset:
        place = ("topic", "partition", "offset")
        full = full.repartitionByRange(*place).sortWithinPartitions(*place)
    full.write.mode("append").parquet(path)
