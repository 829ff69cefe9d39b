"""Event-time tumbling-window counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(
    messages: DataFrame,
    window: str = "1 minute",
    watermark: str | None = None,
    time_col: str = "createdAt",
    key: str = "text",
) -> DataFrame:
    """window_start, window_end, key, count per half-open epoch-aligned window.

    With ``watermark`` the count is a bounded-state streaming aggregation:
    rows too late for their window are dropped and finished windows evicted.
    Partial counts are combined map-side before the shuffle on (window, key).
    """
    df = messages.withWatermark(time_col, watermark) if watermark else messages
    return (
        df.groupBy(F.window(time_col, window).alias("window"), key)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            key,
            "count",
        )
    )
