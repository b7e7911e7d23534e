"""From raw documents to training shards: five stages, each written as Parquet
and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plaudit.llm import decontam, materialise, mixing, quality, simhash
from plaudit.llm.common import drop, scratch_path, scratch_scope

# Token shares of the mix; the budget keeps the clean domain's tokens and adds
# a surplus, so that clean documents stay and the other domains shrink.
MIX_WEIGHTS = {"clean": 0.97, "low": 0.01, "toxic": 0.02}
MIX_SURPLUS = 1.15


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.7 by the quality classifier go."""
    return quality.keep_good(docs, quality.fit(docs, _table(spark, sf_dir, "labels")), threshold=0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the smallest id."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a 10-word window of a benchmark item go."""
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"), window=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the domains meet MIX_WEIGHTS."""
    return mixing.mixed_documents(docs, _table(spark, sf_dir, "labels"), MIX_WEIGHTS, keep="clean",
                                  surplus=MIX_SURPLUS)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in permuted order; returns the manifest of sequences."""
    return materialise.materialise(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("training_order", training_order),
]

# Compression, SimHash and tokenising are beyond SQL; tests/llm/test_pipeline.py
# holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. A stage's table is dropped when the next
    one is written, its operators' scratch tables when it is written itself."""
    docs, last = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        if last:
            drop(last)
        last = path
    with scratch_scope(spark, keep=("shards", "manifest")):
        out = STAGES[-1][1](spark, docs, sf_dir)
    drop(last)
    return out
