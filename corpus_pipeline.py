"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing and sharding of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linegauge.llm import decontaminate, mixing, quality, sharding, simhash
from linegauge.llm.common import documents
from linegauge.session import scratch_path

SHARDS = 24
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return quality.quality(docs, documents(spark, sf_dir, "labels")).where("kept").select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of linked fingerprints: the one with the smallest id."""
    return simhash.deduplicate(docs).select(COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too little of the benchmark to count as contaminated."""
    return decontaminate.decontaminate(docs, documents(spark, sf_dir, "benchmark")).select(COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix(docs).select(COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and place, by a slot map made from what the earlier stages kept."""
    return sharding.shard_documents(docs, SHARDS, scratch_path(spark, "pipeline-slot-map"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources", source_mixing),
    ("sharding", shards),
]

#: The stages use hashes and sketches that SQL lacks; tests compare the pipeline with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each one's result stored as Parquet and read by the next."""
    docs = documents(spark, sf_dir)
    for n, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{n}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
