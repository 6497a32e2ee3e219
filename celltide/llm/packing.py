"""Best-fit packing planned on a histogram of lengths.

Documents are tokenised where they lie and only their lengths are counted.  Best fit, longest first, runs over the
counts (at most ``capacity`` different lengths, however many documents), and yields slots: so many pieces of one length
at such places.  Pieces then take slots by joining on their rank within their length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celltide.llm.common import pieces_of, staged, workers_import
from celltide.llm.vocab import vocabulary, word_encoder

CAPACITY, END_ID, VOCABULARY = 4096, 1, "word_bpe_49k.json"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
SLOT = "length long, first_rank long, last_rank long, for_each long, first_sequence long, first_offset long"


def _cut(path: str | None, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path or vocabulary(VOCABULARY))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows, values in pieces_of(batch, "text", 2 << 20):
                out: list[tuple] = []
                every, first = encode(values)
                for doc_id, a, b in zip(rows.column("doc_id").to_pylist(), first[:-1], first[1:]):
                    ids = every[a:b].tobytes() + end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        out.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return run


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """(slots as in ``SLOT``, number of sequences) for ``counts[length]`` pieces of each length up to ``capacity``.

    Bins with equal room are handled together: the same as best fit decreasing piece by piece, but its cost follows
    the number of lengths, not of pieces.
    """
    groups: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins)
    rooms: list[int] = []  # sorted keys of groups
    slots, bins = [], 0

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in groups:
                groups[room] = []
                bisect.insort(rooms, room)
            groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            each = room // length
            full = min(n, left // each)
            if full:
                slots.append((length, rank, rank + full * each - 1, each, first, capacity - room))
                rank, left = rank + full * each, left - full * each
                add(room - each * length, first, full)
            if full < n and left:  # fewer pieces than one more bin would hold
                slots.append((length, rank, rank + left - 1, left, first + full, capacity - room))
                add(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            add(room, first + full, n - full)
    return slots, bins


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each row of ``docs`` (``doc_id``, ``text``), with its place in a sequence.

    A document is its ids (``path``: a tokenizers file; by default the public word vocabulary) and ``end_id``; only a
    longer one than ``capacity`` is cut.  Null or empty text is the end id alone.  Rows that share a ``doc_id``, or have
    none, are separate documents.  An empty table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    workers_import(spark)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pieces = staged(table.mapInArrow(_cut(path, capacity, end_id, with_ids), PIECE), "pieces")

    # rank within a length, without one task for a frequent length: rank within (length, share) after the counts before
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)).cast("int"))
    counts = dealt.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = counts.select("length", "share", (F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots, _ = best_fit(histogram, capacity)
    plan = spark.createDataFrame(slots, SLOT)  # its size depends on `capacity`, not on the number of pieces
    own = F.row_number().over(Window.partitionBy("length", "share").orderBy("doc_id", "piece"))
    ranked = dealt.withColumn("own", own).join(before, ["length", "share"]).withColumn("rank", F.col("before") + F.col("own") - 1)
    rank = F.col("rank") - F.col("first_rank")
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & F.col("rank").between(F.col("first_rank"), F.col("last_rank"))).drop(plan["length"])
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first_sequence") + F.floor(rank / F.col("for_each"))).alias("sequence_id"),
                         (F.col("first_offset") + rank % F.col("for_each") * F.col("length")).alias("offset"), *(["ids"] if with_ids else []))
