"""Result tables in order: range-clustered files, and an index of them.

Each file holds one range of the sort columns and is sorted itself, so a file's
row groups are in order too; the index has a row for each file with its least and
greatest key. The first rows of the whole table are in its first files, and a
total order is the files one after another: neither needs a sort of the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 1 << 20


def write_clustered(rows: DataFrame, order: Sequence[str], path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``rows`` (a table read from files; it's counted first) in files of about ``rows_per_file``."""
    files = max(1, -(-rows.count() // rows_per_file))
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(f"{path}/data")
    written = rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/data")
    key = F.struct(*order)
    index = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("rows"))
    index.write.parquet(f"{path}/index")


def index_of(spark: SparkSession, path: str) -> DataFrame:
    """file, low, high and rows of every file."""
    return spark.read.parquet(f"{path}/index")


def first_rows(spark: SparkSession, path: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of the whole table, from as many files as hold them."""
    files, held = [], 0
    for r in index_of(spark, path).orderBy("low").limit(n).collect():  # every file has a row at least
        if held >= n:
            break
        files.append(r["file"])
        held += r["rows"]
    if not files:
        return spark.read.parquet(f"{path}/data").limit(n)
    return spark.read.parquet(*files).orderBy(*order).limit(n)


def in_order(spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The table's files as frames, in order, each sorted: to be read one after another."""
    for r in index_of(spark, path).orderBy("low").toLocalIterator():
        yield spark.read.parquet(r["file"])
