"""Streaming sinks for window counts.

* ``append_parquet``: file sink, append mode; each window is written once,
  after the watermark passes its end.
* ``ChangelogUpsert``: update mode through ``foreachBatch``.  Each batch is
  written to its own ``batch_id=<N>`` partition by dynamic partition
  overwrite, so a replayed batch replaces itself (at-least-once delivery
  becomes an idempotent table).  ``latest_view`` reads the table back as one
  row per key: the values from the highest batch that wrote the key.
  ``keyed.KeyedTable`` is the same with buckets that are compacted one by one.
* ``JdbcUpsert``: the same batches into a database table through a staging
  table of the batch's own and one upsert per batch (needs a reachable database;
  not exercised in this repository's tests, which start no database).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

BATCH_COL = "batch_id"
#: The batch id of a compacted base: below any that a query can write.
BASE_BATCH = -1


def append_parquet(stream: DataFrame, path: str, checkpoint: str, name: str) -> DataStreamWriter:
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )


def console(stream: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
    return (
        stream.writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .queryName(name)
    )


class ChangelogUpsert:
    """foreachBatch target writing a replay-safe change log.

    Batch ids start again at 0 under a new checkpoint, so a table belongs to
    one query: the first batch records the checkpoint's query id in a hidden
    ``_run`` marker beside the data, and a query with another id is refused
    instead of overwriting good batches with partial ones.  With ``adopt`` it
    may take over a table that holds nothing but a compacted base, whose batch
    id no query writes: its batches then come on top of the base."""

    def __init__(self, table: str, on_written: Callable[[DataFrame, int], None] | None = None, adopt: bool = False):
        self.table = table
        self.on_written = on_written
        self.adopt = adopt
        self.checkpoint: str | None = None
        self._owner_checked = False

    def _check_owner(self, spark: SparkSession) -> None:
        if self._owner_checked or self.checkpoint is None:
            return
        run_id = json.loads(spark.read.text(f"{self.checkpoint}/metadata").first()[0])["id"]
        owner = _owner(spark, self.table)
        if owner != run_id:
            if owner is not None and not (self.adopt and _only_base(spark, self.table)):
                raise RuntimeError(
                    f"change-log table {self.table} belongs to query {owner}, not {run_id}; "
                    "use a new table, or compact this one and adopt the result")
            _mark_owner(spark, self.table, run_id)
        self._owner_checked = True

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._check_owner(batch.sparkSession)
        # The update output holds only the keys changed in this batch; keep
        # it so the emptiness check and the write share one computation of
        # the stateful plan, and skip the write job for empty batches (such
        # as the no-data batches that only advance the watermark).
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if kept.isEmpty():
                return
            self.write(kept, batch_id)
            if self.on_written is not None:
                self.on_written(kept, batch_id)
        finally:
            kept.unpersist()

    def write(self, rows: DataFrame, batch_id: int) -> None:
        (
            rows.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_COL)
            .parquet(self.table)
        )

    def writer(self, stream: DataFrame, checkpoint: str, name: str) -> DataStreamWriter:
        self.checkpoint = checkpoint
        return (
            stream.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .queryName(name)
            .foreachBatch(self)
        )


def _owner(spark: SparkSession, table: str) -> str | None:
    """The query that a table belongs to, or None; a marker that can't be read is an error."""
    try:
        return spark.read.parquet(f"{table}/_run").first()["run_id"]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _mark_owner(spark: SparkSession, table: str, run_id: str) -> None:
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("overwrite").parquet(f"{table}/_run")


def _only_base(spark: SparkSession, table: str) -> bool:
    return spark.read.parquet(table).where(F.col(BATCH_COL) != BASE_BATCH).isEmpty()


def latest_view(spark: SparkSession, table: str, key: Sequence[str]) -> DataFrame:
    """One row per key with the values of the latest batch that wrote it.

    Partial aggregation runs before the shuffle on the key, so the shuffle
    carries at most one row per key per task whatever the number of batches.
    A compacted table holds its base and the batches since, nothing older.
    """
    log = spark.read.parquet(table)
    values = [c for c in log.columns if c not in key and c != BATCH_COL]
    latest = F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("__lw_latest")
    return log.groupBy(*key).agg(latest).select(*key, *[F.col(f"__lw_latest.{c}").alias(c) for c in values])


def compact(spark: SparkSession, table: str, key: Sequence[str], into: str) -> None:
    """Write the latest view as the base of a new table ``into``; ``table`` stays as it is.

    The base's batch id is one that no query writes, and the owner goes along:
    the same query can go on with ``into`` (its next batches have higher ids),
    another one has to adopt it.  Stop the query while compacting."""
    latest_view(spark, table, key).withColumn(BATCH_COL, F.lit(BASE_BATCH).cast("long")).write.partitionBy(
        BATCH_COL
    ).parquet(into)
    _mark_owner(spark, into, _owner(spark, table) or "none")


class JdbcUpsert:
    """foreachBatch target upserting into a keyed database table.

    Each batch goes into a staging table named after query and batch with
    Spark's JDBC writer (``batchsize`` rows per round trip); then one upsert
    and the drop of the staging table run in one transaction.  Replays rewrite
    the same values.  ``dialect``: "postgres" (INSERT ... ON CONFLICT) or
    "merge" (MERGE, in its standard form).  The driver class is loaded by the
    session's class loader when ``props`` name it as ``driver``.
    """

    def __init__(self, url: str, table: str, key: Sequence[str], value_cols: Sequence[str],
                 props: dict[str, str] | None = None, batchsize: int = 500, dialect: str | None = None, query: str = "counts"):
        self.url, self.table, self.key, self.values = url, table, list(key), list(value_cols)
        self.props = dict(props or {})
        self.batchsize = batchsize
        self.dialect = dialect or ("postgres" if url.startswith("jdbc:postgresql:") else "merge")
        self.query = re.sub(r"\W", "_", query)

    def staging(self, batch_id: int) -> str:
        return f"{self.table}_staging_{self.query}_{batch_id}"

    def upsert_sql(self, batch_id: int) -> str:
        cols = ", ".join(self.key + self.values)
        source = self.staging(batch_id)
        if self.dialect == "postgres":
            new = ", ".join(f"{v} = EXCLUDED.{v}" for v in self.values)
            return f"INSERT INTO {self.table} ({cols}) SELECT {cols} FROM {source} ON CONFLICT ({', '.join(self.key)}) DO UPDATE SET {new}"
        on = " AND ".join(f"t.{k} = s.{k}" for k in self.key)
        new = ", ".join(f"{v} = s.{v}" for v in self.values)
        given = ", ".join(f"s.{c}" for c in self.key + self.values)
        return (f"MERGE INTO {self.table} t USING {source} s ON {on} "
                f"WHEN MATCHED THEN UPDATE SET {new} WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({given})")

    def _connect(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        given = jvm.java.util.Properties()
        for k, v in self.props.items():
            given.setProperty(k, v)
        if "driver" in self.props:
            loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
            return loader.loadClass(self.props["driver"]).getDeclaredConstructor().newInstance().connect(self.url, given)
        return jvm.java.sql.DriverManager.getConnection(self.url, given)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        (
            batch.write.format("jdbc").mode("overwrite")
            .option("url", self.url).option("dbtable", self.staging(batch_id))
            .option("batchsize", str(self.batchsize))
            .options(**self.props).save()
        )
        conn = self._connect(batch.sparkSession)
        try:
            conn.setAutoCommit(False)
            statement = conn.createStatement()
            try:
                statement.executeUpdate(self.upsert_sql(batch_id))
                statement.executeUpdate(f"DROP TABLE {self.staging(batch_id)}")
                conn.commit()
            except BaseException:
                conn.rollback()
                raise
            finally:
                statement.close()
        finally:
            conn.close()
