"""The registered queries: oracles in DuckDB, and the pipeline against brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from test_host_quality import brute as good
from test_minhash import brute as near
from test_packing import naive_best_fit, placed_without_overlap
from test_substring_dedup import brute as passages
from tokenizers import Tokenizer

import corpus_pipeline
from celltide.llm.queries import ORACLES, QUERIES
from celltide.llm.toxicity import toxicity
from tools.oracle_check import rows_of

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    assert rows_of(QUERIES[name](spark, DIR).toPandas()) == rows_of(con.execute(ORACLES[name]).df())


def test_every_operator_has_a_query():
    assert sorted(int(x[2:].split("_")[0]) for x in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {x[0] for x in good([(r.doc_id, r.source, r.text) for r in rows.values()]) if x[-1]}
    left = docs.filter(docs["doc_id"].isin(list(kept)))
    kept = {r.doc_id for r in toxicity(left, labels).collect() if not r.predicted}
    groups = near([(d, rows[d].text) for d in sorted(kept)])
    kept = sorted(d for d, _, c in groups if d == c)
    texts = {x[0]: b" ".join(x[4]).decode() for x in passages([(d, rows[d].text) for d in kept], 20)}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    want = {}
    for d, t in texts.items():
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want |= {(d, n): (at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes())) for n, at in enumerate(range(0, len(ids), 4096))}
    got = corpus_pipeline.run(spark, DIR).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    lengths = [r.length for r in got]
    assert placed_without_overlap([(r.sequence_id, r.offset, r.length) for r in got], 4096) == len(naive_best_fit({x: lengths.count(x) for x in lengths}, 4096))


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_column_types_match_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    own = {f.name: KINDS[f.dataType.simpleString()] for f in QUERIES[name](spark, DIR).schema.fields}
    other = con.sql(ORACLES[name])
    assert own == dict(zip(other.columns, map(str, other.types)))


def test_rows_that_share_a_doc_id_are_documents_of_their_own(spark):
    from celltide.llm.stages import near_duplicates
    from llm_cases import awkward, prose

    texts = prose(31, 12, size=120)
    docs = awkward(spark, texts)
    clash = docs.filter("doc_id between 1 and 6").selectExpr("7 as doc_id", *[c for c in docs.columns if c != "doc_id"])
    docs = docs.unionByName(clash)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    named = sorted({r for r in rows if r[0] is not None}, key=lambda r: (r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()))
    kept = [named[i] for i, _, c in near(list(enumerate(named_text for _, named_text in named))) if i == c]
    got = near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(kept + [r for r in rows if r[0] is None], key=str)
    assert sum(r[0] == 7 for r in kept) >= 1
