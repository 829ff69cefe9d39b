"""logweave: Spark-native analytics over framed-Avro message logs.

Reads Kafka-shaped log records (from Kafka or from a Parquet log table of the
same shape), decodes them tolerantly with column expressions, counts messages
in watermarked event-time windows, and writes append-only or replay-safe
keyed results.  Retry, back-off, dead-letter routing and inspection are plain
DataFrame operations.
"""

__version__ = "0.1.0"
