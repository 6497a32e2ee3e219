"""One query for each operator: production parameters, whole tables, the operator's digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm import decontaminate, host_quality, importance, licenses
from celltide.llm.bpe_chunks import encode_documents
from celltide.llm.minhash import near_duplicates
from celltide.llm.packing import pack
from celltide.llm.spelling import DROP_ONE_IN, spelling_variants
from celltide.llm.substring_dedup import substring_dedup
from celltide.llm.token_files import read_ids, write_ids
from celltide.llm.topk import exact_top_k
from celltide.llm.toxicity import toxicity
from celltide.llm.warc import read_archives, write_archives
from celltide.storage import new_location

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"))


ORACLES["op2_exact_top_k"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_location(spark, "archives")
    write_archives(_table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).filter("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op5_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_location(spark, "token-files")
    write_ids(_table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path)


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op8_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.quality_rules(_table(spark, sf_dir, "documents"))


ORACLES["op8_host_quality"] = host_quality.ORACLE


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"), licenses.ALL, running=True)


ORACLES["op10_license_scan"] = licenses.ORACLE


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"), drop_one_in=DROP_ONE_IN)


@query
def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


ORACLES["op13_decontaminate"] = decontaminate.ORACLE
