"""The corpus pipeline: each stage calls one operator of logweave.llm on all that the stage before kept.

Every stage but the last returns the columns of ``documents``; the last returns
the pieces that were packed. A stage's docstring says what it decides.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from logweave.llm import lines, mixing, packing, quality, simhash
from logweave.llm.storage import staged

#: SimHash near-duplicates: words in a shingle, and bits in which near copies may differ.
SHINGLE, BITS = 3, 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs; n_chars is that of the new text."""
    return lines.without_later_copies(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest doc_id."""
    return simhash.one_of_each(docs, SHINGLE, BITS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (not at all, or up to twice)."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("lines", line_stage), ("near-duplicates", near_duplicate_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, in order, on the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: SQL cannot express the classifier's training.
ORACLE_SQL = None
