"""Substring dedup by seed and extend.

Every window of ``window`` words is anchored at its winnowed seed: the smallest hash among the ``gram``-word grams
inside it (leftmost on ties), so equal windows have equal anchors at equal offsets.  A run of neighbouring windows
with one anchor is a block.  Documents are joined on anchors; a block that equals an earlier document's block is a
repeat as a whole (both ways extended to its ends), and where blocks of one anchor differ, their windows are extended
one by one, by a 128-bit digest of their words.  Neighbouring repeated windows join into maximal repeats, whose words are
removed.

Order and identity: a window is removed if the same word sequence starts in a row with a smaller ``doc_id`` or earlier
in the same row.  Rows that share a ``doc_id`` never count as earlier than each other.  A row with a null ``doc_id`` is
compared with itself only.  Null text is an empty text: no words, nothing removed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import pieces_of, staged, staged_at, workers_import
from celltide.llm.textscan import U, Words, mix, range_hash, scan, window_digests, window_hash
from celltide.storage import delete_path

#: Words of a repeat, and of a seed: shorter seeds are fewer, but more of them are shared by chance or by short common lines.
WINDOW, GRAM = 20, 9
#: Blocks of an anchor from which on it is hot, and the number of keys over which a hot anchor is dealt.
HOT, SALTS = 10_000, 32


class Anchors:
    """Blocks of a run of documents: windows ``low[b]..high[b]`` share the anchor gram at word ``at[b]``."""

    def __init__(self, words: Words, window: int, gram: int):
        h = words.hashes
        n_grams, width = len(h) - gram + 1, window - gram + 1
        document = words.document
        if len(h) < window:
            self.start = self.block_of = self.low = self.high = self.at = self.document = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, U)
            return
        grams = window_hash(h, gram)
        bits = U(int(n_grams).bit_length())
        low_bits = (U(1) << bits) - U(1)
        best = (grams & ~low_bits) | np.arange(n_grams, dtype=U)
        reach = 1
        while reach * 2 <= width:
            best = np.minimum(best[:-reach], best[reach:])
            reach *= 2
        if reach < width:
            best = np.minimum(best[: len(best) - (width - reach)], best[width - reach:])
        start = np.arange(len(best))
        start = start[start + window <= words.first[1:][document[start]]]
        anchor = (best[start] & low_bits).astype(np.int64)
        new = np.ones(len(start), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        at_new = np.flatnonzero(new)
        self.start = start
        self.block_of = np.cumsum(new) - 1
        self.low = start[at_new]
        self.high = start[np.append(at_new[1:], len(start)) - 1] if len(start) else start
        self.at = anchor[at_new]
        self.hashes = grams[self.at]
        self.document = document[self.low]


def _repeats_inside(words: Words, found: Anchors, window: int) -> np.ndarray:
    """Positions in ``found.start`` of windows that start earlier in the same document."""
    if not len(found.at):
        return np.zeros(0, np.int64)
    own = mix(found.hashes + mix(found.document.astype(U) + U(1)))
    _, which, count = np.unique(own, return_inverse=True, return_counts=True)
    rows = np.flatnonzero((count[which] > 1)[found.block_of])
    start = found.start[rows]
    key = mix(window_hash(words.hashes, window)[start] + mix(words.document[start].astype(U) + U(1)))
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    earlier, repeat = start[first][which], np.ones(len(rows), bool)
    repeat[first] = False
    for i in range(window):  # word by word
        repeat &= words.hashes[earlier + i] == words.hashes[start + i]
    return rows[repeat]


def _tags(values: pa.Array) -> np.ndarray:
    return np.array([zlib.crc32(x.as_buffer()) for x in values], np.int64)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _seeds(window: int, gram: int):
    """(anchor, block, doc_id, at): one row for each block; ``at`` is the anchor's word << 32 | crc32 of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words = scan(values)
                found = Anchors(words, window, gram)
                if not len(found.at):
                    continue
                block = range_hash(words.hashes, found.low, found.high + window)
                block = mix(block + (found.at - found.low).astype(U))
                ids = rows.column("doc_id").to_numpy()
                at = ((found.at - words.first[found.document]) << 32) | _tags(values)[found.document]
                yield pa.record_batch([_signed(found.hashes), _signed(block), pa.array(ids[found.document]), pa.array(at)],
                                      names=["anchor", "block", "doc_id", "at"])

    return run


def _marked(rows: pa.RecordBatch, words: Words, column: str) -> np.ndarray:
    """Word positions in the run of documents, from lists of positions in each document."""
    lists = rows.column(column)
    lengths = np.asarray(pa.compute.list_value_length(lists).fill_null(0))
    return np.asarray(lists.flatten(), np.int64) + np.repeat(words.first[:-1], lengths)


def _finish(rows: pa.RecordBatch, values: pa.Array, words: Words, covered: np.ndarray, window: int, with_text: bool,
            wanted: np.ndarray) -> dict[str, list]:
    """Counts, hash and text of what stays; ``covered``: starts of repeated windows."""
    n = len(words.hashes)
    change = np.bincount(covered, minlength=n + 1) - np.bincount(covered + window, minlength=n + 1)
    keep = np.cumsum(change)[:n] == 0
    out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "removed", "kept_text")}
    for d in wanted:
        a, b = words.first[d], words.first[d + 1]
        text, own = values[int(d)].as_py(), keep[a:b]
        gone = int(b - a - own.sum())
        split = text.split()
        out["n_words"].append(int(b - a))
        out["n_removed"].append(gone)
        if not gone:
            out["kept_sha256"].append(hashlib.sha256(b" ".join(split)).hexdigest())
            out["removed"].append([])
            out["kept_text"].append(text.decode() if with_text else None)
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([True], own, [True])).astype(np.int8)))
        out["kept_sha256"].append(hashlib.sha256(b" ".join(compress(split, own.tolist()))).hexdigest())
        out["removed"].append([{"begin": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
        if not with_text:
            out["kept_text"].append(None)
            continue
        base, stay = words.bounds[d], np.flatnonzero(np.diff(np.concatenate(([False], own, [False])).astype(np.int8)))
        out["kept_text"].append(b" ".join(text[words.begin[a + x] - base:words.end[a + y - 1] - base] for x, y in stay.reshape(-1, 2)).decode())
    return out


RESULT = "n_words long, n_removed long, kept_sha256 string, removed array<struct<begin:int,end:int>>, kept_text string"


def _schema(ddl: str, rest: DataFrame) -> T.StructType:
    """The columns of ``ddl`` and then the carried struct."""
    return T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField("rest", rest.schema["rest"].dataType, True)])


_SPAN = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
_RESULT_TYPES = [pa.int64(), pa.int64(), pa.string(), _SPAN, pa.string()]


def _extend(window: int, gram: int, with_text: bool):
    """Finished documents, windows to compare one by one, and the texts that wait for those (as ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words = scan(values)
                found = Anchors(words, window, gram)
                repeated = np.zeros(len(found.start), bool)
                repeated[_repeats_inside(words, found, window)] = True
                block_at = np.full(len(words.hashes) + 1, -1)
                block_at[found.at] = np.arange(len(found.at))
                whole = np.zeros(len(found.at) + 1, bool)
                whole[block_at[_marked(rows, words, "whole")]] = True
                apart = np.zeros(len(found.at) + 1, bool)
                apart[block_at[_marked(rows, words, "apart")]] = True
                if len(found.at):
                    repeated |= whole[found.block_of]
                    look = np.flatnonzero(apart[found.block_of] & ~repeated)
                else:
                    look = np.zeros(0, np.int64)
                waits = np.asarray(pa.compute.list_value_length(rows.column("apart")).fill_null(0)) > 0
                ids, tags = rows.column("doc_id"), rows.column("tag")
                yield _batch(rows, _finish(rows, values, words, found.start[repeated], window, with_text, np.flatnonzero(~waits)), np.flatnonzero(~waits))
                d = np.flatnonzero(waits)
                if len(d):
                    texts = values.take(pa.array(d)).cast(pa.large_string())
                    yield _rows(len(d), doc_id=ids.take(pa.array(d)), tag=tags.take(pa.array(d)), rest=rows.column("rest").take(pa.array(d)), text=texts.cast(pa.string()), whole=rows.column("whole").take(pa.array(d)))
                if len(look):
                    start = found.start[look]
                    own = words.document[start]
                    halves = window_digests(values, words, start, window).view("<i8").reshape(-1, 2)
                    yield _rows(len(look), rest=pa.nulls(len(look), rows.column("rest").type), doc_id=ids.take(pa.array(own)), tag=tags.take(pa.array(own)), at=pa.array((start - words.first[own]).astype(np.int32)), first_half=pa.array(halves[:, 0]), second_half=pa.array(halves[:, 1]))

    return run


_KINDS: dict[str, pa.DataType] = {"doc_id": pa.int64(), "tag": pa.int64(), "at": pa.int32(), "first_half": pa.int64(), "second_half": pa.int64(), "text": pa.string(), "whole": pa.list_(pa.int32())}


def _rows(n: int, **given) -> pa.RecordBatch:
    """A batch with the given columns and nulls elsewhere."""
    kinds = _KINDS | dict(zip(("n_words", "n_removed", "kept_sha256", "removed", "kept_text"), _RESULT_TYPES))
    columns = {k: given.get(k, None) for k in kinds}
    arrays = [pa.nulls(n, kinds[k]) if v is None else v.cast(kinds[k]) for k, v in columns.items()]
    return pa.record_batch([*arrays, given["rest"]], names=[*kinds, "rest"])


def _batch(rows: pa.RecordBatch, done: dict[str, list], which: np.ndarray) -> pa.RecordBatch:
    take = pa.array(which)
    given = {k: pa.array(v, t) for (k, v), t in zip(done.items(), _RESULT_TYPES)}
    return _rows(len(which), doc_id=rows.column("doc_id").take(take), rest=rows.column("rest").take(take), **given)


def _resolve(window: int, gram: int, with_text: bool):
    """The waiting documents, with the windows found to be repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words = scan(values)
                found = Anchors(words, window, gram)
                repeated = np.zeros(len(found.start), bool)
                repeated[_repeats_inside(words, found, window)] = True
                block_at = np.full(len(words.hashes) + 1, -1)
                block_at[found.at] = np.arange(len(found.at))
                whole = np.zeros(len(found.at) + 1, bool)
                whole[block_at[_marked(rows, words, "whole")]] = True
                if len(found.at):
                    repeated |= whole[found.block_of]
                covered = np.concatenate((found.start[repeated], _marked(rows, words, "single")))
                every = np.arange(rows.num_rows)
                done = _finish(rows, values, words, covered, window, with_text, every)
                yield pa.record_batch([rows.column("doc_id"), *(pa.array(v, t) for v, t in zip(done.values(), _RESULT_TYPES)), rows.column("rest")],
                                      names=["doc_id", *done, "rest"])

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, with_text: bool = False,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): counts, removed word ranges and hash of the kept words.

    ``with_text`` adds the kept text (unchanged where nothing is removed, else the kept stretches joined by a space);
    ``carry`` names columns to return beside the result, as the struct ``rest``.  Other columns are ignored, whatever
    their names.  Defined results: an empty table gives an empty result; see the module's text for nulls and ties.
    """
    spark = docs.sparkSession
    workers_import(spark)
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    rest = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("string")
    table = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.crc32(F.coalesce(text, F.lit(""))).alias("tag"), rest.alias("rest"))
    found = table.filter("doc_id is not null and text is not null").select("doc_id", "text") \
        .mapInArrow(_seeds(window, gram), "anchor long, block long, doc_id long, at long")
    # aggregates are written before they are joined: then the rows they are joined with can be dealt anew where a key is hot
    shared = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high")).filter("n > 1") \
        .select("anchor", (F.col("low") != F.col("high")).alias("several"), (F.col("n") > HOT).alias("hot"))
    shared, shared_at = staged_at(shared, "anchors")
    seeds, seeds_at = staged_at(found.join(shared, "anchor"), "seeds")

    # the rows of a hot anchor are dealt over SALTS keys, and its blocks repeated for each
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    blocks = seeds.groupBy("anchor", "block").agg(F.min("doc_id").alias("first"), F.max("hot").alias("hot")).select("anchor", "block", "first", F.explode(salts).alias("salt"))
    salted = seeds.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "at"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    later = F.col("doc_id") > F.col("first")
    place = F.shiftright("at", 32).cast("int")
    marks = salted.join(blocks, ["anchor", "block", "salt"]).filter(later | F.col("several")) \
        .select("doc_id", F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag"), F.when(later, place).alias("whole"), F.when(~later, place).alias("apart")) \
        .groupBy("doc_id", "tag").agg(F.collect_list("whole").alias("whole"), F.collect_list("apart").alias("apart"))
    kinds = ("doc_id long, tag long, at int, first_half long, second_half long, text string, whole array<int>, "
             f"{RESULT}")
    extended = staged(table.join(marks, ["doc_id", "tag"], "left").mapInArrow(_extend(window, gram, with_text), _schema(kinds, table)), "repeats")
    for used in (shared_at, seeds_at):
        delete_path(spark, used)

    singles = extended.filter("at is not null").select("first_half", "second_half", "doc_id", "tag", "at")
    firsts = singles.groupBy("first_half", "second_half").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("last > first").drop("last")
    firsts = staged(firsts, "firsts")
    single = singles.join(firsts, ["first_half", "second_half"]).filter(later) \
        .groupBy("doc_id", "tag").agg(F.collect_list("at").alias("single"))
    waiting = extended.filter("text is not null").select("doc_id", "tag", "text", "whole", "rest")
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed", "kept_text", "rest"]
    late = waiting.join(single, ["doc_id", "tag"], "left").mapInArrow(_resolve(window, gram, with_text), _schema(f"doc_id long, {RESULT}", table))
    return extended.filter("n_words is not null").select(columns).unionByName(late.select(columns))
