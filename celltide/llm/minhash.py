"""Near-duplicate classes by MinHash.

A document is its set of word shingles.  Equal sets become one class, named by the smallest ``doc_id``.  Each class has
a signature, the minima of many universal hash functions over its set.  Signatures are cut into bands; classes that
agree on a band are candidates.  In each bucket every member is held against the bucket's smallest member, by signature
and then on the full sets, and the links give components (large-star, small-star).  A bucket whose members are all in
one component needs no more.  In the others, members of different components are compared in tiles of bounded size: by
signature alone, and the texts of those that agree on the full sets.  A tile gives only the links that join its components.  So no link between
components is lost, and a large group of copies costs one comparison for each copy and band.

With 32 bands of 4 minima, two sets of similarity 0.8 share no band with a probability below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.llm.common import pieces_of, staged, staged_at, workers_import
from celltide.llm.components import components
from celltide.llm.textscan import U, mix, range_hash, scan, window_hashes
from celltide.storage import delete_path

SHINGLE, PERCENT, BANDS, ROWS, TILE = 4, 80, 32, 4, 256
#: Columns of an incidence matrix at a time.
COLUMNS = 8192
#: Share of equal minima below which two sets of the wanted similarity have signatures with a probability below 1e-6.
MARGIN = 0.19


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of ``n`` hash functions h -> (a * h + b) >> 32, from a fixed seed."""
    draw = np.random.default_rng(7).integers(0, 1 << 64, (2, n), dtype=U)
    return draw[0] | U(1), draw[1]


def _sets(values: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of each text in ascending order, one after another; where each text's begin, and the end)."""
    words = scan(values, fold_case=True)
    start, hashes = window_hashes(words, k)
    document = words.document[start]
    count = np.diff(words.first)
    few = np.flatnonzero((count > 0) & (count < k))
    hashes = np.concatenate((hashes, range_hash(words.hashes, words.first[few], words.first[few + 1])))
    document = np.concatenate((document, few)).astype(np.uint16 if len(count) < 1 << 16 else np.int64)
    order = np.argsort(hashes)
    order = order[np.argsort(document[order], kind="stable")]
    hashes, document = hashes[order], document[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (document[1:] != document[:-1])
    hashes, document = hashes[new], document[new]
    return hashes, np.searchsorted(document, np.arange(len(count) + 1))


def _sign(k: int, n: int):
    """Signature and fingerprint of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        multiply, add = _functions(n)
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                hashes, first = _sets(values, k)
                size = np.diff(first)
                some = np.flatnonzero(size)
                signature = np.zeros((len(size), n), np.uint32)
                halves = np.zeros((2, len(size)), U)
                if len(some):
                    at = first[some]
                    for i in range(n):
                        signature[some, i] = np.minimum.reduceat((hashes * multiply[i] + add[i]) >> U(32), at)
                    for half, salt in zip(halves, (U(0x51ED270B0A1F39C1), U(0xC2B2AE3D27D4EB4F))):
                        half[some] = np.add.reduceat(mix(hashes ^ salt), at)
                raw = signature.astype("<u4").tobytes()
                yield pa.record_batch(
                    [rows.column("doc_id"), rows.column("tag"), pa.array(size.astype(np.int64)), pa.array(halves[0].view(np.int64)), pa.array(halves[1].view(np.int64)),
                     pa.array([raw[4 * n * d:4 * n * (d + 1)] for d in range(len(size))], pa.binary())],
                    names=["doc_id", "tag", "n_shingles", "set_1", "set_2", "signature"])

    return run


def _shingles(text: bytes, k: int) -> set[bytes]:
    """The shingles themselves, of a folded text's words joined by a space."""
    words = text.lower().split()
    return {b" ".join(words[i:i + k]) for i in range(max(len(words) - k, 0) + 1)} if words else set()


def _confirm(k: int, percent: int, least_equal: int):
    """Links among pairs (a, b) with both signatures and texts, confirmed on the shingles themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, None  # the set of the last b: pairs come grouped by it
        for batch in batches:
            a_ids, b_ids = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            links = []
            for i, (a, b) in enumerate(zip(a_ids, b_ids)):
                signs = [np.frombuffer(batch.column(x)[i].as_buffer(), "<u4") for x in ("signature_a", "signature_b")]
                if int((signs[0] == signs[1]).sum()) < least_equal:
                    continue
                own = _shingles(batch.column("text_a")[i].as_py().encode(), k)
                if held != b:
                    held, known = b, _shingles(batch.column("text_b")[i].as_py().encode(), k)
                common = len(own & known)
                if 100 * common >= percent * (len(own) + len(known) - common):
                    links.append((a, b))
            if links:
                yield pa.record_batch([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return run


def _common(hashes: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right``, by products of incidence matrices."""
    size = np.diff(first)
    owner = np.repeat(np.arange(len(size)), size)
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    several = count[number] > 1  # a shingle of one set is in no intersection
    renumber = np.cumsum(count > 1) - 1
    owner, number = owner[several], renumber[number[several]]
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, (low, low + COLUMNS))
        part = np.zeros((len(size), COLUMNS), np.float32)
        part[owner[a:b], number[a:b] - low] = 1
        out += part[left] @ part[right].T
    return out


def _likely(signs: np.ndarray, component: np.ndarray, left: np.ndarray, right: np.ndarray, least_equal: int) -> np.ndarray:
    """Which of ``left`` and ``right`` are of different components and agree in enough minima."""
    out = np.zeros((len(left), len(right)), bool)
    for at, x in enumerate(left):
        out[at] = (component[right] != component[x]) & ((signs[right] == signs[x]).sum(1) >= least_equal)
    return out


def _agreeing(least_equal: int):
    """The members of one tile of a bucket whose signature agrees with another's across it."""

    def run(tile: pa.Table) -> pa.Table:
        component, block = (tile.column(x).to_numpy() for x in ("component", "block"))
        signs = np.frombuffer(b"".join(tile.column("signature").to_pylist()), "<u4").reshape(len(block), -1)
        i, j = (tile.column(x)[0].as_py() for x in ("i", "j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        likely = _likely(signs, component, left, right, least_equal)
        some = np.union1d(left[likely.any(1)], right[likely.any(0)])
        return tile.select(["bucket", "node"]).take(pa.array(some, pa.int64()))

    return run


def _compare(k: int, percent: int, least_equal: int):
    """Links between components in one tile of a bucket, as few as join what the tile joins."""

    def run(tile: pa.Table) -> pa.Table:
        component, block = (tile.column(x).to_numpy() for x in ("component", "block"))
        signs = np.frombuffer(b"".join(tile.column("signature").to_pylist()), "<u4").reshape(len(block), -1)
        i, j = (tile.column(x)[0].as_py() for x in ("i", "j"))
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        likely = _likely(signs, component, left, right, least_equal)
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while x in joined:
                x = joined[x]
            return x

        out: list[tuple[int, int]] = []
        if likely.any():
            left, right, likely = left[likely.any(1)], right[likely.any(0)], likely[likely.any(1)][:, likely.any(0)]
            rows = np.union1d(left, right)
            texts = tile.column("text").take(pa.array(rows)).combine_chunks().cast(pa.large_binary())
            hashes, first = _sets(texts, k)
            left, right, size = np.searchsorted(rows, left), np.searchsorted(rows, right), np.diff(first)
            common = _common(hashes, first, left, right)
            likely &= 100 * common >= percent * (size[left][:, None] + size[right][None, :] - common)
            for x, y in np.argwhere(likely):
                a, b = find(int(component[rows[left[x]]])), find(int(component[rows[right[y]]]))
                if a != b:
                    joined[max(a, b)] = min(a, b)
                    out.append((max(a, b), min(a, b)))
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, tile: int = TILE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (``doc_id``, ``text``).

    Words are runs of bytes other than space and ``\\t``-``\\r``, with A-Z as a-z.  A text with fewer words than a shingle is
    one shingle; one without words, or null, has none and is linked with nothing.  Documents are linked if their sets
    have ``percent`` of their union in common; ``component_id`` is the smallest ``doc_id`` reachable.  Repeated rows
    give a row each; rows that share a ``doc_id`` are one node of the graph.  A row without a ``doc_id`` is no node: its
    ``component_id`` is null and it is kept.  An empty table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    workers_import(spark)
    n, text = bands * rows, F.coalesce(F.col("text").cast("string"), F.lit(""))
    least_equal = int((percent / 100 - MARGIN) * n)
    table = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.crc32(text).alias("tag"))
    used: list[str] = []  # folders of tables that the result does not need

    def kept_while_used(df: DataFrame, kind: str) -> DataFrame:
        out, path = staged_at(df, kind)
        used.append(path)
        return out

    signed = kept_while_used(table.mapInArrow(_sign(shingle, n), "doc_id long, tag long, n_shingles long, set_1 long, set_2 long, signature binary"), "signatures")
    own_set = ["set_1", "set_2", "n_shingles"]
    rows_of = staged(signed.select("doc_id", *own_set), "sets")
    some = rows_of.filter("n_shingles > 0 and doc_id is not null")
    # aggregates are written before they are joined: then the members of a large class or bucket can be dealt anew
    classes = kept_while_used(some.groupBy(own_set).agg(F.min("doc_id").alias("node")), "sets-by-node")
    members = some.select("doc_id", *own_set).distinct().join(classes, own_set).select("doc_id", *own_set, "node")
    members = staged(members, "members")
    classes = kept_while_used(members.filter("doc_id = node").join(signed.withColumnRenamed("doc_id", "node"), ["node", *own_set]).dropDuplicates(["node", *own_set])
                     .select("node", "tag", "signature"), "classes")
    # a doc_id with several texts is one node: link its classes
    several = members.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("last > b").select("doc_id", "b")
    same_id = members.join(several, "doc_id").select(F.col("node").alias("a"), "b")

    key = F.expr(f"xxhash64(band, substring(signature, band * {4 * rows} + 1, {4 * rows}))")
    banded = classes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).select("node", key.alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("size")).filter("size > 1")
    buckets = kept_while_used(buckets, "bucket-heads")
    shared = kept_while_used(banded.join(buckets, "bucket"), "buckets")

    # every member against its buckets' heads
    pairs = kept_while_used(shared.filter("node > head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "pairs")
    ends = shared.select("node").distinct()
    wanted = classes.join(ends, "node", "left_semi").withColumnRenamed("node", "doc_id")
    texts = kept_while_used(table.join(wanted, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"]).select(F.col("doc_id").alias("node"), "text", "signature"), "texts")
    as_end = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}"), F.col("signature").alias(f"signature_{x}"))
    both = pairs.join(as_end("a"), "a").join(as_end("b"), "b").select("a", "b", "signature_a", "signature_b", "text_a", "text_b")
    links = both.mapInArrow(_confirm(shingle, percent, least_equal), "a long, b long")
    found = staged(components(links.unionByName(same_id)), "components")

    # members of one bucket that are still in several components
    labelled = shared.filter("size > 2").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("high > low").select("bucket")
    open_rows = labelled.filter("node != head").join(mixed, "bucket").withColumn("blocks", F.ceil(F.col("size") / tile).cast("int")) \
        .withColumn("block", F.pmod(F.hash("node"), "blocks")).join(classes.select("node", "signature"), "node")

    def into_tiles(members: DataFrame, *carried: str) -> DataFrame:
        """The members of each bucket in the tiles of their block with every block."""
        return members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
            .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "component", "signature", *carried)

    tiled = into_tiles(open_rows)
    # texts are fetched only for members whose signatures agree in a tile, once for each bucket
    agreeing = tiled.groupBy("bucket", "i", "j").applyInArrow(_agreeing(least_equal), "bucket long, node long").distinct()
    agreeing = kept_while_used(agreeing, "agreeing")
    tiled = into_tiles(open_rows.join(agreeing, ["bucket", "node"], "left_semi").join(texts.select("node", "text"), "node"), "text")
    more = tiled.groupBy("bucket", "i", "j").applyInArrow(_compare(shingle, percent, least_equal), "a long, b long")
    merged = components(more).select(F.col("node").alias("component"), F.col("component").alias("into"))

    for path in used:
        delete_path(spark, path)
    labels = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(merged, "component", "left") \
        .select("doc_id", *own_set, F.coalesce("into", "component").alias("component"))
    out = rows_of.join(labels, ["doc_id", *own_set], "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
