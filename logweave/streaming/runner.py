"""Staged runs: a Parquet log table filled batch by batch and consumed by a
streaming query with ``availableNow`` triggers.

``append`` adds one batch of log records (new files); ``run`` starts the query
from its checkpoint, processes everything new and stops: a restart resumes at
the next offset.  A run's micro-batches take a bounded number of files.  After
the last data batch Spark runs a no-data batch when the watermark moved, so with
one run for each staged batch, the watermark that decides lateness in batch k is
(max event time of batches 0..k-1) - delay.  All folders live under the
session's checkpoint folder, one fresh folder per run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..schemas import LOG_SCHEMA
from ..session import new_run_dir
from ..sources.log import read_log


class StagedLog:
    def __init__(self, spark: SparkSession, name: str, admission: dict[str, str] | None = None):
        """``admission``: maxFilesPerTrigger or maxBytesPerTrigger of the log table's source."""
        self.spark = spark
        self.name = name
        self.admission = admission or {}
        self.root = new_run_dir(spark, name)
        self.log_path = f"{self.root}/log"
        self.batches: list[int] = []

    def path(self, sub: str) -> str:
        return f"{self.root}/{sub}"

    def append(self, records: DataFrame) -> None:
        records.select(*LOG_SCHEMA.names).write.mode("append").parquet(self.log_path)

    def stream(self) -> DataFrame:
        return read_log(self.spark, self.admission, path=self.log_path, streaming=True)

    def run(self, build: Callable[[DataFrame], DataStreamWriter]) -> StreamingQuery:
        """Start the query over everything staged so far and wait for it."""
        q = build(self.stream()).trigger(availableNow=True).start()
        q.awaitTermination()
        last = q.lastProgress
        if last is not None:
            self.batches.append(last.batchId)  # the last batch id of each run
        return q

    def feed(self, batches: list[DataFrame], build: Callable[[DataFrame], DataStreamWriter]) -> None:
        """Append and run batch by batch."""
        for b in batches:
            self.append(b)
            self.run(build)
