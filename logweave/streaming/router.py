"""Streaming dead-letter routing: the consumer side as a foreachBatch target.

Each micro-batch is decoded, classified and written once, to one table that is
partitioned by query, batch and outcome, with dynamic partition overwrite: a
replayed batch replaces itself, and another query (a new checkpoint, whose batch
ids start again) writes beside it.  ``processed`` and ``dead_letters`` read one
side.  With a topic as target, a batch's dead letters are read back from the
table and published (at least once).  Batch N+1 starts after batch N has been
written, so order between batches holds as with a blocking consumer.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..operators.deadletter import DEAD_LETTER, PROCESSED, PROCESSED_COLUMNS, REQUIRED, DeadLetterConfig, Rule, route, shaped
from ..schemas import LOG_SCHEMA
from ..sources.log import write_log
from .sinks import BATCH_COL

QUERY_COL = "query_id"
TABLE_SCHEMA = StructType([*LOG_SCHEMA.fields, StructField("id", StringType()), StructField("text", StringType()), StructField("createdAt", TimestampType()),
                           StructField(QUERY_COL, StringType()), StructField(BATCH_COL, LongType()), StructField("outcome", StringType())])


class DeadLetterRouter:
    def __init__(self, table: str, rules: Sequence[Rule] = REQUIRED, config: DeadLetterConfig = DeadLetterConfig(),
                 publish: dict[str, str] | None = None):
        """``publish``: Kafka settings with which dead letters also go to a topic."""
        self.table = table
        self.rules, self.config, self.publish = rules, config, publish
        self.checkpoint: str | None = None
        self._query: str | None = None

    def query_id(self, spark: SparkSession) -> str:
        """The id that the checkpoint keeps over restarts."""
        if self._query is None:
            meta = spark.read.text(f"{self.checkpoint}/metadata").first()[0] if self.checkpoint else '{"id": "none"}'
            self._query = json.loads(meta)["id"]
        return self._query

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = self.query_id(spark)
        rows = shaped(route(batch, self.rules, self.config), self.config)
        (
            rows.withColumn(QUERY_COL, F.lit(query)).withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(QUERY_COL, BATCH_COL, "outcome")
            .parquet(self.table)
        )
        if self.publish is not None:
            mine = (F.col(QUERY_COL) == query) & (F.col(BATCH_COL) == batch_id)
            write_log(dead_letters(spark, self.table, mine), self.publish)

    def writer(self, log_stream: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
        self.checkpoint = checkpoint
        return (
            log_stream.writeStream.option("checkpointLocation", checkpoint)
            .queryName(name)
            .foreachBatch(self)
        )


def processed(spark: SparkSession, table: str) -> DataFrame:
    """The records that a router table's queries processed."""
    return spark.read.schema(TABLE_SCHEMA).parquet(table).where(F.col("outcome") == PROCESSED).select(*PROCESSED_COLUMNS)


def dead_letters(spark: SparkSession, table: str, where=None) -> DataFrame:
    """The dead letters of a router table, in the shape of log records."""
    rows = spark.read.schema(TABLE_SCHEMA).parquet(table).where(F.col("outcome") == DEAD_LETTER)
    return (rows if where is None else rows.where(where)).select(*LOG_SCHEMA.names)
