"""Business-key dedupe of a message stream.

A producer that restarts, or a caller that sends the same thing twice, writes a
second record that a log can't tell from a new one; only a key of the message
itself can. The key's state lives for a stated delay of event time, so it's
bounded by what arrives within the delay and not by the stream's length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dedupe(messages: DataFrame, delay: str, key: Sequence[str] = ("id",), time_col: str = "timestamp") -> DataFrame:
    """The first message of each key; later ones are dropped until ``delay`` has passed.

    ``time_col`` is when a message was sent (its log timestamp): a resend has a
    later one than its first copy. A resend that arrives after the watermark has
    passed the first copy's time plus ``delay`` counts as a new message, and a
    message older than the watermark is dropped. One shuffle, on the key.
    """
    if not messages.isStreaming:
        raise ValueError("dedupe keeps state over a stream's batches; for a table use dropDuplicates")
    return messages.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(key))
