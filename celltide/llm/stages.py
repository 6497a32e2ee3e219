"""The corpus pipeline's stages: operators applied to whole tables, with their decisions carried out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import host_quality, minhash, packing, substring_dedup, toxicity
from celltide.llm.common import staged
from celltide.llm.importance import ranked


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    return host_quality.keep_good(docs)


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half for toxicity."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest ``doc_id``, then of the smallest digest of the text.

    Rows are numbered by (``doc_id``, text), so rows that share a ``doc_id`` are documents of their own and go only if their
    text is a copy or near copy of one that stays.  Of rows that share both, one stays; every row without a ``doc_id`` stays.
    """
    digest = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    keyed = docs.filter("doc_id is not null").select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("_id"), digest.alias("_digest"))
    numbers = ranked(staged(keyed.select("_id", "_digest").distinct(), "keys"), "_id", "_digest").select("_id", "_digest", F.col("rank").alias("doc_id"))
    own = staged(keyed.join(numbers, ["_id", "_digest"]).dropDuplicates(["_id", "_digest"]).select("doc_id", "row"), "numbered")
    kept = minhash.near_duplicates(own.select("doc_id", F.col("row.text").alias("text"))).filter("kept").select("doc_id")
    one = own.join(staged(kept, "kept"), "doc_id", "left_semi").select("row.*")
    return one.unionByName(docs.filter("doc_id is null")).select(*(F.col(f"`{c}`") for c in docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one has; ``n_chars`` follows the text."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    found = substring_dedup.substring_dedup(docs, with_text=True, carry=carry)
    text = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*(text.get(c, F.col(f"rest.`{c}`") if carry else F.lit(None)).alias(c) for c in docs.columns))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return packing.pack(docs)
