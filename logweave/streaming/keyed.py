"""A keyed table in two levels: deltas of single batches, and buckets of settled rows.

::

    deltas/after=G/batch_id=N/bucket=B/   rows that batch N changed, after compaction G
    base/generation=G/bucket=B/           bucket B after batch G, one row a key
    commits/generation=G/                 the buckets that compaction G wrote

A bucket is a function of the key. A compaction folds the deltas since the last
one into the buckets that they touch and leaves every other bucket's files alone;
its commit record, written last, makes it visible. So a bucket's rows come from its
newest generation and from the deltas since: at most ``compact_every`` of them,
each with the bucket's rows in one task's files, and no older delta is even listed. Buckets that no open delta
touches are read as they are, without a shuffle.

A repeated batch replaces its own delta, a repeated compaction its own generation:
both are keyed by the batch id. Files that no read uses any more are listed by
``obsolete``; nothing is deleted here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import read_or_none
from .sinks import BATCH_COL, ChangelogUpsert

BUCKET, GENERATION = "bucket", "generation"
COMPACT_EVERY = 8


def hashed(key: Sequence[str], buckets: int = 64) -> Column:
    """Buckets of equal size: right for keys that are changed all over the table."""
    return F.concat(F.lit("h"), F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("string"))


def daily(time_col: str, key: Sequence[str] = (), parts: int = 1) -> Column:
    """A bucket (or a few) for each day: right for window counts, whose changes are recent."""
    day = F.date_format(time_col, "yyyyMMdd")
    return F.concat(F.lit("d"), day, F.lit("-"), F.pmod(F.xxhash64(*(key or [time_col])), F.lit(parts)).cast("string"))


class KeyedTable(ChangelogUpsert):
    """foreachBatch target (update mode) that keeps the newest row of each key."""

    def __init__(self, table: str, key: Sequence[str], bucket: Column | None = None, compact_every: int = COMPACT_EVERY,
                 on_written: Callable[[DataFrame, int], None] | None = None):
        super().__init__(table, on_written)
        self.key = list(key)
        self.bucket = bucket if bucket is not None else hashed(self.key)
        self.compact_every = compact_every

    def write(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        newest = current(spark, self.table)[0]
        dealt = rows.withColumn(BUCKET, self.bucket).withColumn(BATCH_COL, F.lit(batch_id).cast("long")).repartition(BUCKET)
        (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL, BUCKET).parquet(f"{self.table}/deltas/after={newest}"))
        if batch_id - newest >= self.compact_every:
            compact(spark, self.table, self.key)


def current(spark: SparkSession, table: str) -> tuple[int, dict[str, int]]:
    """The newest compaction (-1: none), and the generation of each bucket."""
    commits = read_or_none(spark, f"{table}/commits")
    if commits is None:
        return -1, {}
    of = {r[BUCKET]: r["g"] for r in commits.groupBy(BUCKET).agg(F.max(F.col(GENERATION).cast("long")).alias("g")).collect()}
    return max(of.values(), default=-1), of


def _deltas(spark: SparkSession, table: str, after: int) -> DataFrame | None:
    rows = read_or_none(spark, f"{table}/deltas/after={after}")
    return None if rows is None else rows.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long")).where(F.col(BATCH_COL) > after)


def _base(spark: SparkSession, table: str, buckets: dict[str, int]) -> DataFrame | None:
    """The rows of some buckets, each from its own generation."""
    if not buckets:
        return None
    paths = [f"{table}/base/{GENERATION}={g}/{BUCKET}={b}" for b, g in sorted(buckets.items())]
    return spark.read.option("basePath", f"{table}/base").parquet(*paths).drop(GENERATION)


def _newest(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row for each key, the one that the highest batch wrote."""
    values = [c for c in rows.columns if c not in key and c != BUCKET]
    last = F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("__lw_last")
    return rows.groupBy(BUCKET, *key).agg(last).select(*key, *(F.col(f"__lw_last.{c}").alias(c) for c in values), BUCKET)


def _touched(deltas: DataFrame | None) -> set[str]:
    return set() if deltas is None else {r[BUCKET] for r in deltas.select(BUCKET).distinct().collect()}


def view(spark: SparkSession, table: str, key: Sequence[str]) -> DataFrame:
    """The table as a reader sees it: one row for each key."""
    newest, generations = current(spark, table)
    deltas = _deltas(spark, table, newest)
    touched = _touched(deltas)
    settled = _base(spark, table, {b: g for b, g in generations.items() if b not in touched})
    if touched:
        open_base = _base(spark, table, {b: g for b, g in generations.items() if b in touched})
        merged = _newest(deltas if open_base is None else deltas.unionByName(open_base), key)
        settled = merged if settled is None else settled.unionByName(merged)
    if settled is None:
        settled = deltas
    if settled is None:
        raise LookupError(f"{table} holds no batch yet")
    return settled.drop(BATCH_COL, BUCKET)


def compact(spark: SparkSession, table: str, key: Sequence[str]) -> int:
    """Fold all open deltas into the buckets that they touch; the number of buckets written.

    For the table's own query, between two batches, or while that is stopped."""
    newest, generations = current(spark, table)
    deltas = _deltas(spark, table, newest)
    touched = _touched(deltas)
    if not touched:
        return 0
    generation = deltas.agg(F.max(BATCH_COL)).first()[0]
    base = _base(spark, table, {b: g for b, g in generations.items() if b in touched})
    rows = _newest(deltas if base is None else deltas.unionByName(base), key)
    rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{table}/base/{GENERATION}={generation}")
    spark.createDataFrame([(b,) for b in sorted(touched)], f"{BUCKET} string").coalesce(1).write.mode("overwrite").parquet(
        f"{table}/commits/{GENERATION}={generation}")
    return len(touched)


def obsolete(spark: SparkSession, table: str) -> list[str]:
    """Folders that no read uses any more: older generations of rewritten buckets, and folded deltas."""
    newest, generations = current(spark, table)
    commits = read_or_none(spark, f"{table}/commits")
    if commits is None:
        return []
    old = [f"{table}/base/{GENERATION}={r[GENERATION]}/{BUCKET}={r[BUCKET]}"
           for r in commits.select(GENERATION, BUCKET).collect() if r[GENERATION] < generations[r[BUCKET]]]
    folded = spark.read.parquet(f"{table}/deltas").select("after").where(F.col("after") < newest).distinct().collect()
    return sorted(old) + sorted(f"{table}/deltas/after={r['after']}" for r in folded)
