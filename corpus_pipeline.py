"""Corpus pipeline: quality rules, toxicity, near-duplicate groups, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from celltide.llm import stages
from celltide.llm.common import staged

#: Each function takes (spark, docs, sf_dir); all but the last return the columns of ``documents``.
STAGES = [
    ("quality_rules", stages.quality_rules),
    ("toxicity", stages.clean_language),
    ("minhash_near_dedup", stages.near_duplicates),
    ("substring_dedup", stages.repeated_passages),
    ("best_fit_packing", stages.packed_sequences),
]

#: Tokenising, MinHash and the learned score are not SQL; tests/llm holds ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
