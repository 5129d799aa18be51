"""The corpus pipeline: documents in, a mix of clean and different documents out.

STAGES are applied in order, each to all that the one before it kept:

1. quality: documents that the line field predicts to be bad go.
2. line dedup: repeated and near-repeated lines go, texts change.
3. SimHash: of near-duplicate documents one stays.
4. decontamination: documents that hold benchmark passages go.
5. mixing: how much of each document the target weights of its source take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import decontaminate, line_dedup, mixing, quality, simhash
from tallyloom.llm.common import find_package, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents; ``n_chars`` follows the new text. Texts may become empty."""
    find_package(spark)
    kept = line_dedup.dedup(docs, shortest=1).withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_package(spark)
    return simhash.keep_first(docs, whole=True)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"), whole=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    find_package(spark)
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", near_duplicate_stage),
    ("decontaminate", benchmark_stage),
    ("mixing", mixing_stage),
]

#: The line field is learned, so SQL has no twin of the pipeline; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs, f"pipeline-{name}")
    return docs
