"""Building messages to publish: fresh ids, now or back-dated event times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import encode_frames


def created_at(seconds_ago: int | Column = 0) -> Column:
    """Current instant minus ``seconds_ago``, cut to milliseconds."""
    s = seconds_ago if isinstance(seconds_ago, Column) else F.lit(seconds_ago)
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), s.cast("decimal(18,6)"))
    return F.date_trunc("millisecond", F.current_timestamp() - back)


def new_messages(texts: DataFrame, text_col: str = "text", seconds_ago: int | Column = 0) -> DataFrame:
    """id (random UUID), text, createdAt (now - seconds_ago) for each text."""
    return texts.select(
        F.expr("uuid()").alias("id"),
        F.col(text_col).alias("text"),
        created_at(seconds_ago).alias("createdAt"),
    )


def framed(messages: DataFrame, schema_id: int = 1, topic: str | None = None) -> DataFrame:
    """Kafka-shaped records ready for ``write_log``: framed Avro values."""
    out = encode_frames(messages, schema_id=schema_id).select(F.lit(None).cast("binary").alias("key"), "value")
    return out.withColumn("topic", F.lit(topic)) if topic else out


def raw_records(values: DataFrame, value_col: str = "value", topic: str | None = None) -> DataFrame:
    """Records whose bytes are published as they are (poison pills, copies)."""
    out = values.select(F.lit(None).cast("binary").alias("key"), F.col(value_col).cast("binary").alias("value"))
    return out.withColumn("topic", F.lit(topic)) if topic else out
