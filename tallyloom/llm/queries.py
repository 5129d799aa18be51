"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import (
    chat, decontaminate, embeddings, importance, licenses, line_dedup, mixing, neighbours, quality, simhash, spelling, sql, token_counts,
    toxicity,
)
from tallyloom.llm.common import find_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.dedup(_table(spark, sf_dir, "documents"), shortest=1)
    return docs.select("doc_id", "n_lines", "n_dropped", "text")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(_table(spark, sf_dir, "conversations"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_licenses": op1_licenses,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_chat": op4_chat,
    "op5_mixing": op5_mixing,
    "op6_embeddings": op6_embeddings,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_token_counts": op9_token_counts,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_importance": op12_importance,
    "op13_neighbours": op13_neighbours,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB's SQL for the queries that SQL can express; the pipeline has none.
SQL: dict[str, str] = {
    "op1_licenses": sql.LICENSES,
    "op8_decontaminate": sql.DECONTAMINATE,
    "op11_spelling": sql.SPELLING,
    "op12_importance": sql.IMPORTANCE,
}
