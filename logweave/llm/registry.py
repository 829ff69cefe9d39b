"""The registered queries of this subpackage, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm import bpe, chat, contextmix, language, lattice, lines, manifest, mixing, packing, quality, rotation, simhash, topk

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.source_mix(table(spark, sf_dir, "documents"))


def op2_byte_network_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op3_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted_chats(table(spark, sf_dir, "conversations"))


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contextmix.language_model_scores(table(spark, sf_dir, "documents"))


def op5_lattice_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op11_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_block_rotation_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation.fim_digests(table(spark, sf_dir, "documents"))


def op13_merkle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_source_mix, op2_byte_network_languages, op3_chat_turns, op4_context_mixing, op5_lattice_near_duplicates, op6_threshold_topk, op7_line_runs, op8_packing, op9_simhash_gray, op10_quality_discriminant,
                                                   op11_rank_array_bpe, op12_block_rotation_fim, op13_merkle_rollup)}
SQL: dict[str, str] = {"op1_source_mix": mixing.SQL, "op5_lattice_near_duplicates": lattice.SQL, "op6_threshold_topk": topk.SQL, "op7_line_runs": lines.SQL,
                       "op12_block_rotation_fim": rotation.SQL, "op13_merkle_rollup": manifest.SQL}
