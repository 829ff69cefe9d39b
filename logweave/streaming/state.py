"""State of streaming queries: where it is kept, and reading it back.

Spark's default store keeps all state of a task in executor memory. RocksDB
spills to disk, and with changelog checkpoints a batch uploads only what it
changed, so state may be far larger than memory. Which store a query uses is a
setting of the session it starts in; ``state_session`` gives one beside the
caller's, whose own settings stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings of a session whose streaming queries keep their state in RocksDB.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the caller's settings and RocksDB state."""
    session = spark.newSession()
    for key, value in (spark.conf.getAll | ROCKSDB).items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def state(spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0) -> DataFrame:
    """partition_id, key and value of everything in a stateful operator's store, after the
    last batch or after ``batch``. The query may be running or have ended."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, key: str = "text", batch: int | None = None) -> DataFrame:
    """window_start, window_end, key and count of the windows that are still open: those that
    the watermark hasn't passed, and an append-mode sink doesn't show yet."""
    rows = state(spark, checkpoint, batch)
    window = F.col("key")[rows.schema["key"].dataType.names[0]]  # the grouping window comes first
    return rows.select(window["start"].alias("window_start"), window["end"].alias("window_end"),
                       F.col("key")[key].alias(key), F.col("value")["count"].alias("count"))
