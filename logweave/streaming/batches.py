"""foreachBatch targets whose writes can be repeated.

A micro-batch that was written but not yet committed by its query is delivered
again after a crash. Everything here is therefore keyed by the query's id, which
its checkpoint keeps over restarts, and the batch id: a repeated batch replaces
itself, and another query writes beside it.

* ``BatchTable``: a table with a folder for each batch.
* ``MetricsTable`` / ``Measured``: counts of each batch as rows of a table, written
  before the batch is committed, so they outlive the driver.
* ``FanOut``: a log read once for several targets, with a commit record for each.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.decode import decode_messages

QUERY_COL, BATCH_COL = "query_id", "batch_id"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its query."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None if nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class BatchTarget:
    """What a query's ``foreachBatch`` calls; ``writer`` ties it to a checkpoint."""

    checkpoint: str | None = None
    _query: str | None = None

    def query(self, spark: SparkSession) -> str:
        if self._query is None:
            self._query = query_id(spark, self.checkpoint) if self.checkpoint else "none"
        return self._query

    def writer(self, stream: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
        self.checkpoint, self._query = checkpoint, None
        return stream.writeStream.option("checkpointLocation", checkpoint).queryName(name).foreachBatch(self)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        raise NotImplementedError


def write_batch(rows: DataFrame, table: str, query: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{table}/{QUERY_COL}={query}/{BATCH_COL}={batch_id}")


def read_batches(spark: SparkSession, table: str) -> DataFrame:
    """All rows, with the query and the batch that wrote them."""
    rows = spark.read.parquet(table)
    return rows.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long"))


class BatchTable(BatchTarget):
    """A table with one folder for each batch."""

    def __init__(self, table: str):
        self.table = table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, self.table, self.query(batch.sparkSession), batch_id)


class MetricsTable:
    """One row of counts for each batch of each query."""

    def __init__(self, table: str):
        self.table = table

    def put(self, spark: SparkSession, query: str, batch_id: int, counts: dict[str, int]) -> None:
        names = sorted(counts)
        row = spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
        write_batch(row.coalesce(1), self.table, query, batch_id)

    def rows(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, self.table)


class Measured(BatchTarget):
    """Decodes each batch of a log, hands the messages to ``target`` and records how many
    records were received and skipped. ``target`` must write all it is given."""

    def __init__(self, target: BatchTarget, metrics: MetricsTable, decode: Callable[..., DataFrame] = decode_messages):
        self.target, self.metrics, self.decode = target, metrics, decode

    def writer(self, stream: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
        self.target.checkpoint, self.target._query = checkpoint, None
        return super().writer(stream, checkpoint, name)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        self.target(self.decode(batch, observe=seen), batch_id)
        self.metrics.put(batch.sparkSession, self.query(batch.sparkSession), batch_id, seen.get)


@dataclass(frozen=True)
class Branch:
    """One target of a fan-out: ``rows`` of the shared batch, for a table of its own or for ``write``."""

    name: str
    rows: Callable[[DataFrame], DataFrame]
    write: Callable[[DataFrame, int], None] | None = None


class FanOut(BatchTarget):
    """Reads and prepares each batch once and writes it to every branch.

    A branch's write of a batch is followed by its commit record. A batch that comes
    again after a crash goes only to the branches without one; a branch's table
    replaces the folder of the broken write. ``table`` shows committed batches only.
    """

    def __init__(self, root: str, prepare: Callable[[DataFrame], DataFrame], branches: Sequence[Branch],
                 on_written: Callable[[str, int], None] | None = None):
        self.root, self.prepare, self.branches, self.on_written = root, prepare, branches, on_written

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = self.query(spark)
        done = self._committed(spark, query, batch_id)
        todo = [b for b in self.branches if b.name not in done]
        if not todo:
            return
        shared = self.prepare(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for b in todo:
                if b.write is None:
                    write_batch(b.rows(shared), f"{self.root}/{b.name}", query, batch_id)
                else:
                    b.write(b.rows(shared), batch_id)
                if self.on_written is not None:
                    self.on_written(b.name, batch_id)
                record = spark.createDataFrame([(query, batch_id)], f"{QUERY_COL} string, {BATCH_COL} long")
                record.coalesce(1).write.mode("overwrite").parquet(f"{self._commits(query, batch_id)}/branch={b.name}")
        finally:
            shared.unpersist()

    def _commits(self, query: str, batch_id: int) -> str:
        return f"{self.root}/_commits/of_query={query}/of_batch={batch_id}"

    def _committed(self, spark: SparkSession, query: str, batch_id: int) -> set[str]:
        """The branches that have this batch: a folder of its own, so older batches aren't listed."""
        records = read_or_none(spark, self._commits(query, batch_id))
        return set() if records is None else {r["branch"] for r in records.select("branch").distinct().collect()}


def fan_out_table(spark: SparkSession, root: str, branch: str) -> DataFrame:
    """A branch's rows of all committed batches."""
    commits = spark.read.parquet(f"{root}/_commits").where(F.col("branch") == branch).select(QUERY_COL, BATCH_COL)
    return read_batches(spark, f"{root}/{branch}").join(commits, [QUERY_COL, BATCH_COL], "left_semi")
