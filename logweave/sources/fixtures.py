"""The events table seen as a message log.

Mapping: id = event_id as text, text = event_type, createdAt = ts cut to
milliseconds (UTC), key = user_id as text, partition = user_id % 4, offset =
event_id (unique and rising within a partition; a log's offsets may have gaps),
timestamp = createdAt, one header of the event's own.  Some records are poison:
the first matching rule below wins.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import encode_frames, frame_header
from ..schemas import LOG_SCHEMA
from ..session import require_utc

TOPIC = "messages"
PARTITIONS = 4
SCHEMA_ID = 1
HEADER = "event"

# Poison rules, first match wins (event_id modulus, kind).
POISON_RULES = [
    (97, "raw_text"),
    (89, "null"),
    (83, "header_only"),
    (79, "truncated"),
]
RAW_TEXT_PREFIX = "not avro "
#: What follows the id in a raw value: a byte that isn't UTF-8, and more bytes than a preview shows.
RAW_TAIL = b"\xff" + b"-" * 70


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def poison_kind(event_id: Column) -> Column:
    expr = None
    for mod, kind in reversed(POISON_RULES):
        hit = (event_id % mod) == 0
        expr = F.when(hit, F.lit(kind)) if expr is None else F.when(hit, F.lit(kind)).otherwise(expr)
    return expr


def is_poison(event_id: Column) -> Column:
    out = None
    for mod, _ in POISON_RULES:
        hit = (event_id % mod) == 0
        out = hit if out is None else out | hit
    return out


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, id, text, createdAt, partition from the events table."""
    require_utc(spark)
    return read_table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.col("event_id").cast("string").alias("id"),
        F.col("event_type").alias("text"),
        F.date_trunc("millisecond", F.col("ts").cast("timestamp")).alias("createdAt"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
    )


def with_values(msgs: DataFrame, schema_id: int = SCHEMA_ID) -> DataFrame:
    """Add ``value``: framed bytes of each message, or its poison replacement."""
    enc = encode_frames(msgs, out="__lw_full", schema_id=schema_id)
    full = F.col("__lw_full")
    kind = poison_kind(F.col("event_id"))
    raw = F.concat(F.concat(F.lit(RAW_TEXT_PREFIX), F.col("event_id").cast("string")).cast("binary"), F.lit(RAW_TAIL))
    value = (
        F.when(kind.isNull(), full)
        .when(kind == "raw_text", raw)
        .when(kind == "header_only", frame_header(schema_id))
        .when(kind == "truncated", full.substr(F.lit(1), F.lit(6) + F.length(F.col("id").cast("binary"))))
    )
    return enc.select(*msgs.columns, value.alias("value"))


def log_records(spark: SparkSession, sf_dir: str, keep_event_id: bool = False,
                topic: str = TOPIC, schema_id: int = SCHEMA_ID) -> DataFrame:
    """Kafka-shaped records (LOG_SCHEMA) for every event, poison included: a map over the rows."""
    msgs = with_values(messages(spark, sf_dir), schema_id)
    header = F.struct(F.lit(HEADER).alias("key"), F.col("id").cast("binary").alias("value"))
    cols = [
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("value"),
        F.lit(topic).alias("topic"),
        F.col("partition"),
        F.col("event_id").alias("offset"),
        F.col("createdAt").alias("timestamp"),
        F.lit(0).alias("timestampType"),
        F.array(header).cast(LOG_SCHEMA["headers"].dataType).alias("headers"),
    ]
    if keep_event_id:
        cols.append(F.col("event_id"))
    return msgs.select(*cols)


def staged_batches(records: DataFrame, n_batches: int, late_mod: int | None = None) -> list[DataFrame]:
    """Split records (with ``event_id``) into ``n_batches`` ordered batches by
    equal ranges of event_id: batch = floor((event_id - lo) * n / (hi - lo + 1)).
    With ``late_mod``, records with event_id % late_mod = 0 arrive one batch
    later than their range (the last batch keeps its own).  A batch is a filter
    on event_id that reaches the scan."""
    lo, hi = records.agg(F.min("event_id"), F.max("event_id")).first()
    if lo is None:  # no records: every batch is empty
        return [records.drop("event_id") for _ in range(n_batches)]
    lo, span, e = int(lo), int(hi) - int(lo) + 1, F.col("event_id")
    edges = [lo - (-k * span // n_batches) for k in range(n_batches + 1)]  # the first id of each batch

    def between(k: int) -> Column:
        return (e >= edges[k]) & (e < edges[k + 1])

    out = []
    for k in range(n_batches):
        part = between(k)
        if late_mod:
            late = (e % late_mod) == 0
            part = (part & ~late) if k < n_batches - 1 else part
            if k:
                part = part | (between(k - 1) & late)
            part = part & (e >= edges[max(0, k - 1)]) & (e < edges[k + 1])
        out.append(records.filter(part).drop("event_id"))
    return out


#: Resends: which events are sent again at once, and which one batch later; how much later by the log's clock.
AGAIN_MOD, LATER_MOD = 7, 5
AGAIN_AFTER, LATER_AFTER = "INTERVAL 30 MINUTES", "INTERVAL 7 DAYS"
#: Offsets of resent records lie this much behind their first copy's.
RESENT_OFFSETS = 1 << 40


def batches_with_resends(records: DataFrame, n_batches: int) -> list[DataFrame]:
    """``staged_batches`` in which some records are sent twice: the same value, a later timestamp.

    Records with event_id % 7 = 0 come again in their own batch, others with
    event_id % 5 = 0 in the next one."""
    first = staged_batches(records, n_batches)
    at_once = (F.col("offset") % AGAIN_MOD) == 0
    later = ((F.col("offset") % LATER_MOD) == 0) & ~at_once

    def again(batch: DataFrame, which: Column, after: str, shift: int) -> DataFrame:
        return batch.where(which).withColumns({"timestamp": F.col("timestamp") + F.expr(after), "offset": F.col("offset") + shift})

    out = []
    for k, batch in enumerate(first):
        sent = batch.unionByName(again(batch, at_once, AGAIN_AFTER, RESENT_OFFSETS))
        out.append(sent.unionByName(again(first[k - 1], later, LATER_AFTER, 2 * RESENT_OFFSETS)) if k else sent)
    return out


def offset_bounds(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two bounds of offsets, as JSON: partition p's lie at (p + 1) and (p + 6) tenths of all offsets."""
    lo, hi = read_table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    lo, span = (lo, hi - lo + 1) if lo is not None else (0, 0)
    return [json.dumps({TOPIC: {str(p): lo + (p + tenths) * span // 10 for p in range(PARTITIONS)}}) for tenths in (1, 6)]
