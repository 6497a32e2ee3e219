"""Byte-level BPE of whole texts by overlapping chunks, and its decoding.

A long text is cut into chunks that overlap.  Chunks are pre-tokenised in parallel, each from its own first character;
after a few pre-tokens a chunk's boundaries agree with those of the chunk before it.  The first place in the overlap
where both have a boundary, not after white space, is the seam: the pattern looks only ahead, so from there on both go
alike, and what lies before it is cut as in the whole text (a run of white space is cut by what follows).  Where an overlap
has no seam (one pre-token spans it), the chunks on both sides are joined.  The pieces between seams are then encoded
in parallel and their ids concatenated.  Texts that fit one chunk are encoded where they lie.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celltide.llm.common import pieces_of, staged, workers_import
from celltide.llm.vocab import rank_encoder, token_bytes, vocabulary

VOCABULARY, CHUNK, OVERLAP = "byte_bpe_multi_50k.tiktoken", 16_384, 512
#: Characters that the pattern's literal alternatives need to be told apart ('ll): boundaries nearer to a chunk's end are no seams.
LOOKAHEAD = 3
RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"


def _pattern(given: str | None) -> str:
    if given is None:
        import public_tokenizers

        given = public_tokenizers.PATTERN
    return given


def boundaries(pattern: str, text: str) -> list[int]:
    """Where the pattern's matches begin, in order."""
    import regex

    return [m.start() for m in regex.compile(pattern).finditer(text)]


def decode(ids: np.ndarray, path: str | None = None) -> bytes:
    """The bytes of the ids, one after another."""
    return b"".join(map(token_bytes(path or vocabulary(VOCABULARY)).__getitem__, ids.tolist()))


def _digest(ids: bytes, path: str | None, with_ids: bool) -> tuple:
    numbers = np.frombuffer(ids, "<u4")
    return len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(decode(numbers, path)).hexdigest(), ids if with_ids else None


def _result(key: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.binary())
    columns = zip(*rows) if rows else ([], [], [], [])
    return pa.record_batch([key, *(pa.array(v, t) for v, t in zip(columns, kinds))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])


def _encode_short(path: str | None, pattern: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(path or vocabulary(VOCABULARY), _pattern(pattern))
        for batch in batches:
            for rows, values in pieces_of(batch, "text", 4 << 20):
                ids, first = encode(values)
                ids = ids.astype("<u4")
                yield _result(rows.column("doc_id"), [_digest(ids[a:b].tobytes(), path, with_ids) for a, b in zip(first[:-1], first[1:])])

    return run


def _split(chunk: int, overlap: int):
    """(row, n, doc_id, text) of the overlapping chunks of each long text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                parts = [text[at:at + chunk + overlap] for at in range(0, len(text), chunk)]
                for at in range(0, len(parts), 64):
                    own = parts[at:at + 64]
                    yield pa.record_batch([pa.array([row] * len(own), pa.int64()), pa.array(range(at, at + len(own)), pa.int32()), pa.array([doc_id] * len(own), pa.int64()), pa.array(own, pa.string())], names=["row", "n", "doc_id", "text"])

    return run


def _pretokenise(chunk: int, overlap: int, pattern: str | None):
    """Adds the boundaries that may be seams: ``head`` in the overlap before, ``tail`` in the overlap after, both counted from the overlap's start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _pattern(pattern)
        for batch in batches:
            head, tail = [], []
            for text in batch.column("text").to_pylist():
                found = boundaries(own, text)
                head.append([x for x in found if x < overlap])
                tail.append([x - chunk for x in found if chunk <= x <= chunk + overlap - LOOKAHEAD and not text[x - 1].isspace()])
            kind = pa.list_(pa.int32())
            yield pa.record_batch([*(batch.column(x) for x in ("row", "n", "doc_id", "text")), pa.array(head, kind), pa.array(tail, kind)], names=["row", "n", "doc_id", "text", "head", "tail"])

    return run


def _encode_pieces(path: str | None, pattern: str | None, chunk: int):
    """Ids of each stretch of chunks between two seams; ``parts`` are (n, text) in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(path or vocabulary(VOCABULARY), _pattern(pattern))
        for batch in batches:
            out = []
            for seam, until, parts in zip(*(batch.column(x).to_pylist() for x in ("seam", "until", "parts"))):
                text = "".join(p["text"][:chunk] for p in parts[:-1]) + parts[-1]["text"]
                end = None if until is None else chunk * len(parts) + until
                ids, _ = encode(pa.array([text[seam:end].encode()], pa.large_binary()))
                out.append(ids.astype("<u4").tobytes())
            yield pa.record_batch([batch.column("row"), batch.column("first"), pa.array(out, pa.binary())], names=["row", "first", "ids"])

    return run


def _join(path: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_digest(b"".join(p["ids"] for p in parts.as_py()), path, with_ids) for parts in batch.column("parts")]
            yield _result(batch.column("doc_id"), rows)

    return run


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, with_ids: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): number and hash of its ids, and hash of the bytes they decode to.

    ``path``: a file of ranks; ``pattern``: what splits a text before the merges.  Null text is an empty text: no ids.
    Repeated rows, or rows without a ``doc_id``, each give a row.  Other columns are ignored.
    """
    spark = docs.sparkSession
    workers_import(spark)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    fits = F.length("text") <= chunk + overlap
    short = table.filter(fits).mapInArrow(_encode_short(path, pattern, with_ids), f"doc_id long, {RESULT}")

    # `row` is the place in the input: rows that share a doc_id stay apart
    long = table.withColumn("row", F.monotonically_increasing_id()).filter(~fits)
    kinds = "row long, n int, doc_id long, text string"
    chunks = long.mapInArrow(_split(chunk, overlap), kinds).repartition("row", "n")
    chunks = staged(chunks.mapInArrow(_pretokenise(chunk, overlap, pattern), f"{kinds}, head array<int>, tail array<int>"), "chunks")
    order = Window.partitionBy("row").orderBy("n")
    seam = F.array_min(F.array_intersect(F.lag("tail").over(order), F.col("head")))
    seams = chunks.select("row", "n", "head", "tail").withColumn("seam", F.when(F.col("n") == 0, 0).otherwise(seam)) \
        .withColumn("first", F.last(F.when(F.col("seam").isNotNull(), F.col("n")), ignorenulls=True).over(order)).select("row", "n", "first", "seam")
    pieces = seams.join(chunks.select("row", "n", "text"), ["row", "n"]).groupBy("row", "first") \
        .agg(F.max("seam").alias("seam"), F.sort_array(F.collect_list(F.struct("n", "text"))).alias("parts"))
    ends = seams.filter("seam is not null").withColumn("until", F.lead("seam").over(order)).select("row", "first", "until")
    encoded = pieces.join(ends, ["row", "first"]).mapInArrow(_encode_pieces(path, pattern, chunk), "row long, first int, ids binary")
    whole = encoded.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "ids"))).alias("parts")) \
        .join(chunks.filter("n = 0").select("row", "doc_id"), "row").mapInArrow(_join(path, with_ids), f"doc_id long, {RESULT}")
    return short.unionByName(whole)
