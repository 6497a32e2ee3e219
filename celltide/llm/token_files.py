"""Token-id files of directly addressable codes.

A file holds segments, one after another, each closed by a line break.  A segment keeps whole documents in ``doc_id``
order.  Its ids are split into bytes, lowest first: level 0 has the lowest byte of every id, and a bitmap tells which
ids go on; level 1 has the next byte of those, and so on.  A rank directory counts the set bits before each block of
512, so any id is read by one step on each level, with no block to decode.

Layout (little-endian): ``DAC1``; header of unsigned 64-bit numbers: bytes of the segment, task, number in the task,
documents, ids, levels; then for each document its id (signed 64-bit), whether it has one (a byte each), and where its
ids begin (unsigned 64-bit, one more than documents); then for each level: entries (unsigned 64-bit), their bytes, the
bitmap and the rank directory (unsigned 64-bit).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.common import pieces_of, staged, workers_import
from celltide.llm.vocab import byte_encoder, vocabulary

VOCABULARY, END_ID, SEGMENT_IDS = "byte_bpe_50k.json", 2, 1 << 20
MAGIC, HEADER, BLOCK = b"DAC1", struct.Struct("<6Q"), 512
_BITS = np.array([bin(x).count("1") for x in range(256)], np.uint8)  # set bits of a byte


def encode_segment(task: int, number: int, doc_ids: list[int | None], ids: np.ndarray, begins: np.ndarray) -> bytes:
    """``begins`` has one more entry than ``doc_ids``: where each document's ids begin, and their end."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bitmap = np.packbits(more, bitorder="little")
        blocks = np.zeros(-(-len(bitmap) * 8 // BLOCK) * (BLOCK // 8), np.uint8)
        blocks[: len(bitmap)] = _BITS[bitmap]
        directory = np.concatenate(([0], np.cumsum(blocks.reshape(-1, BLOCK // 8).sum(1, dtype=np.uint64)))).astype("<u8")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bitmap.tobytes() + directory.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    known = np.array([x is not None for x in doc_ids], np.uint8).tobytes()
    body = np.array([x or 0 for x in doc_ids], "<i8").tobytes() + known + np.asarray(begins).astype("<u8").tobytes() + b"".join(levels)
    size = len(MAGIC) + HEADER.size + len(body)
    return MAGIC + HEADER.pack(size, task, number, len(doc_ids), len(ids), len(levels)) + body


class Segment:
    """Random access to the ids of a segment that begins at byte ``at`` of ``data``."""

    def __init__(self, data: bytes, at: int = 0):
        if data[at:at + 4] != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        size, self.task, self.number, self.documents, self.ids, levels = HEADER.unpack_from(data, at + 4)
        self.end = at + size
        at += 4 + HEADER.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        raw, known = take("<i8", self.documents), take("u1", self.documents)
        self.doc_ids = [int(x) if k else None for x, k in zip(raw, known)]
        self.begins = take("<u8", self.documents + 1).astype(np.int64)
        self.levels = []
        for _ in range(levels):
            n = int(take("<u8", 1)[0])
            bitmap_bytes = -(-n // 8)
            self.levels.append((take("u1", n), take("u1", bitmap_bytes), take("<u8", -(-bitmap_bytes * 8 // BLOCK) + 1)))

    def _rank(self, level: int, i: int) -> int:
        """Set bits before entry ``i`` of a level's bitmap."""
        _, bitmap, directory = self.levels[level]
        block, byte = i // BLOCK, i // 8
        n = int(directory[block]) + int(_BITS[bitmap[block * (BLOCK // 8):byte]].sum())
        return n + (bin(int(bitmap[byte]) & ((1 << i % 8) - 1)).count("1") if i % 8 else 0)

    def __getitem__(self, i: int) -> int:
        out = 0
        for level, (entries, bitmap, _) in enumerate(self.levels):
            out |= int(entries[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return out

    def read(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end``, by the rank of the two places on each level."""
        out, which, level = np.zeros(end - begin, np.uint32), None, 0
        while begin < end:
            entries, bitmap, _ = self.levels[level]
            part = entries[begin:end].astype(np.uint32) << np.uint32(8 * level)
            if which is None:
                out |= part
                which = np.arange(len(out))
            else:
                out[which] |= part
            first = begin // 8
            more = np.unpackbits(bitmap[first:-(-end // 8)], bitorder="little")[begin - 8 * first:end - 8 * first].astype(bool)
            which = which[more]
            begin, level = self._rank(level, begin) if len(which) else 0, level + 1
            end = begin + len(which)
        return out


def segments(data: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(data):
        segment = Segment(data, at)
        yield segment
        at = segment.end + 1


def _encode(path: str | None, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(path or vocabulary(VOCABULARY))
        task, number = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        lengths: list[int] = []
        in_hand = 0

        def close() -> pa.RecordBatch:
            nonlocal number
            out = encode_segment(task, number, doc_ids, np.concatenate(held), np.concatenate(([0], np.cumsum(lengths))))
            number += 1
            doc_ids.clear(), held.clear(), lengths.clear()
            return pa.record_batch([pa.array([out], pa.binary())], names=["segment"])

        for batch in batches:
            for rows, values in pieces_of(batch, "text", 4 << 20):
                ids, first = encode(values)
                for d, doc_id in enumerate(rows.column("doc_id").to_pylist()):
                    doc_ids.append(doc_id)
                    held.append(np.append(ids[first[d]:first[d + 1]], np.uint32(end_id)))
                    lengths.append(len(held[-1]))
                    in_hand += lengths[-1]
                    if in_hand >= segment_ids:
                        yield close()
                        in_hand = 0
        if doc_ids:
            yield close()

    return run


def write_ids(docs: DataFrame, path: str, vocabulary_path: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every row of ``docs`` (``doc_id``, ``text``), each closed by ``end_id``, in ascending ``doc_id`` order.

    Null text is an empty text; rows without a ``doc_id`` come first; rows that share one follow each other by text.
    Other columns are ignored.  The rows are range-partitioned, so each file holds a range of documents.  Spark's text
    writer commits the files, so a lost executor leaves no half of one.
    """
    workers_import(docs.sparkSession)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = table.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_encode(vocabulary_path, end_id, segment_ids), "segment binary").select(F.col("segment").cast("string")).write.text(path)


def _decode(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                for s in segments(content.as_buffer().to_pybytes()):
                    ids = [s.read(int(a), int(b)).astype("<u4").tobytes() for a, b in zip(s.begins[:-1], s.begins[1:])]
                    n = s.documents
                    yield pa.record_batch(
                        [pa.array(np.full(n, s.task)), pa.array(np.full(n, s.number)), pa.array(s.doc_ids, pa.int64()), pa.array(s.begins[:-1]), pa.array(np.diff(s.begins)),
                         pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids if with_ids else [None] * n, pa.binary())],
                        names=["task", "number", "doc_id", "begin", "n_tokens", "ids_crc32", "ids"])

    return run


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row for each document in the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``.

    ``with_ids`` adds the ids themselves, little-endian unsigned 32-bit.
    """
    workers_import(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(_decode(with_ids), "task long, number long, doc_id long, begin long, n_tokens long, ids_crc32 long, ids binary")
    found = staged(found, "documents-read")
    sizes = found.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))  # a row for each segment
    within = F.sum("n").over(Window.partitionBy("task").orderBy("number")) - F.col("n")
    files = sizes.groupBy("task").agg(F.sum("n").alias("n")).select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("earlier"))
    # a row for each file that was written
    before = sizes.select("task", "number", within.alias("within")).join(F.broadcast(files), "task").select("task", "number", (F.col("earlier") + F.col("within")).alias("before"))
    return found.join(before, ["task", "number"]).select("doc_id", (F.col("before") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
