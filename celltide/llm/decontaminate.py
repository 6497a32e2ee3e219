"""Benchmark decontamination by a broadcast set of item windows.

Words are runs of ASCII letters and digits and of all other than ASCII characters, with A-Z as a-z.  A window is
``window`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.  Windows become
(64-bit hash, 128-bit digest of the words, item).  The distinct ones are dealt into sets of a checked size, in practice
one, and each set is broadcast.  A task hashes every window of its documents, looks them up, and verifies a hit by the
digest of the document's own words.  One set needs no shuffle; of several, each is held against all documents, and what
they find is joined by the text's digest.

Defined results: a null or empty text has no words and no hits; an item with a null or empty text has no windows; an item
without an id has the empty id, and rows of one ``item_id`` are one item.  Each row of ``docs`` gives one row, also rows
that repeat or have no ``doc_id``.  Empty tables give an empty result, or documents without hits.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import pieces_of, staged, workers_import
from celltide.llm.textscan import U, in_words, scan, window_digests, window_hash, window_hashes

WINDOW = 10
#: Bytes of one broadcast set, counted as ENTRY bytes and the item's id for each (window, item).
SET_BYTES, ENTRY = 48 << 20, 40
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_IN_WORD = in_words(SEPARATORS)
_TO_SPACE = bytes(c if inside else 32 for c, inside in enumerate(_IN_WORD))
_STEP = 1 << 18  # windows of an item to emit at a time


def _split(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_SPACE).split()


def _item_windows(window: int):
    """(k, hash, digest, item): each window of ``k`` words of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words = scan(values, True, _IN_WORD)
                item, count = rows.column("item"), np.diff(words.first)
                for k in np.unique(np.minimum(count[count > 0], window)).tolist():
                    hashes = window_hash(words.hashes, k)
                    start = window_hashes(words, k)[0] if k == window else words.first[:-1][count == k]
                    for a in range(0, len(start), _STEP):
                        at = start[a:a + _STEP]
                        digest = window_digests(values, words, at, k, _split)
                        yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(hashes[at].view(np.int64)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(at), [None, pa.py_buffer(digest.tobytes())]).cast(pa.binary()),
                                               item.take(pa.array(words.document[at]))], names=["k", "hash", "digest", "item"])

    return run


def _item_sets(benchmark: DataFrame, window: int, set_bytes: int) -> list[Broadcast]:
    """The windows of all items, in sets of about ``set_bytes``."""
    spark = benchmark.sparkSession
    item, text = F.coalesce(F.col("item_id").cast("string"), F.lit("")), F.col("text").cast("string")
    found = benchmark.select(item.alias("item"), text.alias("text")).mapInArrow(_item_windows(window), "k int, hash long, digest binary, item string")
    found = staged(found.distinct(), "item-windows")
    size = found.agg(F.sum(F.octet_length("item") + ENTRY)).first()[0] or 0
    parts = -(-size // set_bytes)
    part = F.pmod(F.xxhash64("digest", "item"), F.lit(parts))
    return [spark.sparkContext.broadcast(found.filter(part == i).toArrow()) for i in range(parts)]


class ItemSet:
    """Windows of one length: which items have them."""

    def __init__(self, entries: pa.Table):
        hashes = entries.column("hash").to_numpy().view(U)
        digests = np.frombuffer(b"".join(entries.column("digest").to_pylist()), "S16")
        order = np.argsort(digests)
        self.digests, first = np.unique(digests[order], return_index=True)
        self.first = np.append(first, len(order))
        self.items = entries.column("item").take(pa.array(order)).combine_chunks()
        self.hashes = np.unique(hashes)
        self.mask = U((1 << (16 * len(hashes)).bit_length()) - 1)
        self.likely = np.zeros(int(self.mask) + 1, bool)
        self.likely[hashes & self.mask] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of the hashes that some window of an item has."""
        at = np.flatnonzero(self.likely[hashes & self.mask])
        near = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        return at[self.hashes[near] == hashes[at]]

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Number of the window with each digest, or -1."""
        at = np.minimum(np.searchsorted(self.digests, digests), len(self.digests) - 1)
        return np.where(self.digests[at] == digests, at, -1)

    def items_of(self, windows: np.ndarray) -> list[str]:
        return pa.concat_arrays([self.items.slice(self.first[w], self.first[w + 1] - self.first[w]) for w in windows.tolist()]).unique().to_pylist()


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _scan(sent: Broadcast | None, all_rows: bool):
    """Hit word ranges and items of each document; without ``all_rows`` only of those with hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = sent.value if sent else pa.table({"k": pa.array([], pa.int32())})
        sets = {k: ItemSet(entries.filter(pa.compute.equal(entries.column("k"), k))) for k in entries.column("k").unique().to_pylist()}
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words = scan(values, True, _IN_WORD)
                change = np.zeros(len(words.hashes) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for k, known in sets.items():
                    start, hashes = window_hashes(words, k)
                    start = start[known.candidates(hashes)]
                    which = known.find(window_digests(values, words, start, k, _split))
                    start, which = start[which >= 0], which[which >= 0]
                    change += np.bincount(start, minlength=len(change)) - np.bincount(start + k, minlength=len(change))
                    own = words.document[start]
                    for d in np.unique(own).tolist():
                        items.setdefault(d, set()).update(known.items_of(np.unique(which[own == d])))
                covered = np.cumsum(change)[:-1] > 0
                spans = {d: _ranges(covered[words.first[d]:words.first[d + 1]]) for d in items}
                keep = range(len(values)) if all_rows else sorted(items)
                take = pa.array(keep, pa.int64())
                yield pa.record_batch(
                    [rows.column("doc_id").take(take), rows.column("tag").take(take), pa.array(np.diff(words.first)[list(keep)], pa.int64()),
                     pa.array([spans.get(d, []) for d in keep], _SPANS), pa.array([sorted(items.get(d, ())) for d in keep], pa.list_(pa.string())), rows.column("rest").take(take)],
                    names=["doc_id", "tag", "n_words", "spans", "item_ids", "rest"])

    return run


def _ranges(covered: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).astype(np.int8)))
    return [{"begin": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of all sets as disjoint ranges."""
    for batch in batches:
        spans = []
        for own in batch.column("spans").to_pylist():
            out: list[dict[str, int]] = []
            for s in sorted(own, key=lambda x: x["begin"]):
                if out and s["begin"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], s["end"])
                else:
                    out.append(s)
            spans.append(out)
        at = batch.schema.get_field_index("spans")
        yield batch.set_column(at, "spans", pa.array(spans, _SPANS))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, carry: tuple[str, ...] = (), set_bytes: int = SET_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, item_ids, spans, contaminated, rest) for each row of ``docs`` (``doc_id``, ``text``).

    ``spans`` are the ranges of hit words, ``item_ids`` the items (``item_id``, ``text`` of ``benchmark``) with a window
    in the document, sorted as strings.  ``carry`` names columns to return beside the result, as the struct ``rest``.
    """
    workers_import(docs.sparkSession)
    text = F.col("text").cast("string")
    rest = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("string")
    sets = _item_sets(benchmark, window, set_bytes) or [None]
    tag = F.sha2(text, 256) if len(sets) > 1 else F.lit(None).cast("string")
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), tag.alias("tag"), rest.alias("rest"))
    kinds = T.StructType([*T.StructType.fromDDL("doc_id long, tag string, n_words long, spans array<struct<begin:int,end:int>>, item_ids array<string>").fields,
                          T.StructField("rest", table.schema["rest"].dataType, True)])
    found = table.mapInArrow(_scan(sets[0], True), kinds)
    if len(sets) > 1:
        bare = table.withColumn("rest", F.lit(None).cast(table.schema["rest"].dataType))
        more = reduce(DataFrame.unionByName, (bare.mapInArrow(_scan(s, False), kinds).withColumn("part", F.lit(i)) for i, s in enumerate(sets[1:])))
        more = more.groupBy("tag", "part").agg(F.first("spans").alias("spans"), F.first("item_ids").alias("item_ids")) \
            .groupBy("tag").agg(F.flatten(F.collect_list("spans")).alias("spans_2"), F.flatten(F.collect_list("item_ids")).alias("items_2"))
        both = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, F.col(b)))
        joined = found.join(more, "tag", "left").withColumn("spans", both("spans", "spans_2")).withColumn("item_ids", F.array_sort(F.array_distinct(both("item_ids", "items_2"))))
        found = joined.select(kinds.names).mapInArrow(_merge, kinds)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", "spans", (F.size("spans") > 0).alias("contaminated"), "rest")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans; what stays between two cuts is joined by a space."""
    for batch in batches:
        for rows, values in pieces_of(batch, "text"):
            words, texts = scan(values, True, _IN_WORD), []
            for d, spans in enumerate(rows.column("spans").to_pylist()):
                text, first, base = values[d].as_py(), words.first[d], words.bounds[d]
                at, kept = 0, []
                for s in spans:
                    kept.append(text[at:words.begin[first + s["begin"]] - base].strip())
                    at = words.end[first + s["end"] - 1] - base
                texts.append(b" ".join(x for x in (*kept, text[at:].strip()) if x).decode())
            yield pa.record_batch([pa.array(texts, pa.string()), rows.column("rest")], names=["text", "rest"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, remove: str = "spans") -> DataFrame:
    """``docs`` without what the benchmark holds: ``remove`` the ``spans`` of hit words, or whole ``documents``.

    Rows without hits, and columns other than ``text``, stay as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    found = find_contamination(docs, benchmark, window, carry=tuple(docs.columns))
    clean = found.filter(~F.col("contaminated")).select("rest.*")
    if remove == "documents":
        return clean
    kinds = T.StructType([T.StructField("text", T.StringType()), T.StructField("rest", found.schema["rest"].dataType)])
    cut = found.filter("contaminated").select(F.col("rest.text").cast("string").alias("text"), "spans", "rest").mapInArrow(_cut, kinds)
    return clean.unionByName(cut.select(*((F.col("text") if c == "text" else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns)))


#: The same by joining window texts, for ``window`` = 10.
ORACLE = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_starts AS (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS win FROM item_starts),
starts AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k),
windows AS (SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS win FROM starts),
hits AS (SELECT r, s, k, item FROM windows JOIN item_windows USING (k, win)),
hit_words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""
