"""Small fixed inputs for unit tests (registered queries use the real tables)."""

import datetime as dt

from pyspark.sql import functions as F

from logweave.functions.codec import encode_frames
from logweave.schemas import LOG_SCHEMA

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)


def at(mmss: str) -> dt.datetime:
    m, s = mmss.split(":")
    return T0 + dt.timedelta(minutes=int(m), seconds=int(s))


def log_rows(spark, rows, start_offset=0):
    """rows: (text, createdAt) -> Kafka-shaped records on partition 0."""
    df = spark.createDataFrame(
        [(f"id-{start_offset + i}", t, c, start_offset + i) for i, (t, c) in enumerate(rows)],
        "id string, text string, createdAt timestamp, offset long")
    enc = encode_frames(df)
    return enc.select(
        F.lit(None).cast("binary").alias("key"), "value", F.lit("messages").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.col("createdAt").alias("timestamp"),
        F.lit(0).alias("timestampType"), F.lit(None).cast(LOG_SCHEMA["headers"].dataType).alias("headers"))
