"""Tables written to the shared folder, and small helpers on frames."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import new_run_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and read it back.

    This cuts the lineage: what follows reads files that outlive any executor.
    """
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark drops an execution's shuffle files as soon as it ends, not when the driver's memory is next collected.

    For executions that end in a staged table or in rows on the driver; the session's setting is put back.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def word_count(text: Column) -> Column:
    """The words of a text, runs of bytes other than space and 0x09-0x0D; null counts as empty.

    Each word becomes one letter and the letters are counted: no list of words is built."""
    one = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+", "x")
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.length(one)).otherwise(0)


def remainder(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; null for null."""
    return F.crc32(F.col(column).cast("string")) % n
