"""Tolerant decode of log records into messages, with per-batch counts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.codec import decode_frames
from ..schemas import MESSAGE_AVRO_SCHEMA

DECODE_METRICS = "log_decode"


def decoded(record: str = "record") -> Column:
    """A decoded record is non-null with a non-null required field."""
    return F.col(record).isNotNull() & F.col(f"{record}.id").isNotNull()


def decode_messages(log: DataFrame, observe: str | Observation | None = DECODE_METRICS,
                    schema: str = MESSAGE_AVRO_SCHEMA, avro_package: bool = False,
                    schemas: dict[int, str] | None = None) -> DataFrame:
    """Drop and count undecodable records; keep id, text, createdAt plus the
    log position columns.  ``schema`` is the writer schema's text (see
    ``sources.catalog.latest_schema``); with ``schemas`` each record is read with
    the one that its frame names, and others are skipped.  Counts are taken before the filter:
    ``received`` = all records, ``skipped`` = dropped ones."""
    rec = decode_frames(log, "value", "record", schema, avro_package, schemas)
    # Always observed: besides the counts, CollectMetrics is the barrier
    # that keeps the filter below from being pushed into (and inlining) the
    # staged decode projections, or below a repartition of the input.
    rec = rec.observe(
        observe if observe is not None else f"{DECODE_METRICS}_{uuid.uuid4().hex[:8]}",
        F.count(F.lit(1)).alias("received"),
        F.count_if(~decoded()).alias("skipped"),
    )
    return rec.filter(decoded()).select(
        F.col("record.id").alias("id"),
        F.col("record.text").alias("text"),
        F.col("record.createdAt").alias("createdAt"),
        "topic",
        "partition",
        "offset",
        "timestamp",
    )
