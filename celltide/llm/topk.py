"""Exact top-k inner products without random access (NRA).

Vectors become integers.  In a block of vectors, each component has a list of (value, row), sorted by value; a query reads
the lists of its components from the end that its sign favours, in blocks of growing depth.  What was read is kept from
block to block: the partial score of each row, and which of its components were seen.  A component that was not seen is at
most the value at the list's current depth and at least the list's last value, so every row has a lower and an upper
score.  Rows whose upper score is below the k-th best lower score drop out; when a few times k are left, reading stops and
the scores of those, and of no others, are computed from their vectors.

Vectors and queries meet in tiles, a block of each.  A tile's queries read together: what a block of all lists brings is
multiplied by all queries at once.  Each vector is sent once for each part of the queries of its length (parts of ``block``
queries), and each query once for each block of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celltide.llm.common import workers_import

K, SCALE, BLOCK = 5, 256, 16_384
EXACT = 2.0**52  # below this, sums of integers in double precision are exact


def _exact_kind(vectors: np.ndarray, queries: np.ndarray) -> type:
    """Double precision where sums of the products are exact in it, else Python's integers."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(vectors.shape[1], 1)
    return np.float64 if most < EXACT else object


class Lists:
    """Sorted lists of (value, row) of a block of vectors, one for each component.

    ``read`` counts the entries that queries have read, ``scored`` the rows whose vector was looked up.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.rows = np.argsort(vectors, axis=0, kind="stable").T
        self.values = np.take_along_axis(vectors.T, self.rows, axis=1)
        self.read = self.scored = 0

    def _block(self, begin: int, end: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """Entries ``begin`` to ``end`` of all lists, by row and component; 0 where none is."""
        out = np.zeros((len(self.ids), len(self.rows)), kind)
        got = np.zeros(out.shape, bool)
        component = np.repeat(np.arange(len(self.rows)), end - begin)
        rows = self.rows[:, begin:end].ravel()
        out[rows, component] = self.values[:, begin:end].ravel()
        got[rows, component] = True
        return out, got

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, resolve: int = 4) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, ids, scores) of the best k other rows of each query, ties to the smaller id.

        Reading for a query stops when ``resolve * k`` rows are left.
        """
        n, d = self.vectors.shape
        kind = _exact_kind(self.vectors, queries)
        asked = queries.T.astype(kind)
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        ends = self.values[:, [0, -1]].astype(kind) if n else np.zeros((d, 2), kind)
        known = np.zeros((n, len(queries)), kind)
        seen_top, seen_low = np.zeros((n, d), bool), np.zeros((n, d), bool)
        alive = self.ids[:, None] != query_ids[None, :]
        number, depth, step = np.arange(len(queries)), 0, max(n // 16, 1)
        while len(number):
            left = alive.sum(0) > resolve * k
            if depth >= n:
                left[:] = False
            for at in np.flatnonzero(~left):
                own = np.flatnonzero(alive[:, at])
                scores = self.vectors[own].astype(kind) @ asked[:, number[at]]
                self.scored += len(own)
                which = np.lexsort((self.ids[own], -scores))[:k]
                yield int(query_ids[number[at]]), self.ids[own[which]], scores[which]
            number, alive, known = number[left], alive[:, left], known[:, left]
            if not len(number):
                return
            until = min(n, depth + step)
            self.read += (until - depth) * int((asked[:, number] != 0).sum())
            rows = np.flatnonzero(alive.any(1))
            for seen, own, (begin, end) in ((seen_top, up, (n - until, n - depth)), (seen_low, down, (depth, until))):
                values, got = self._block(begin, end, kind)
                known[rows] += values[rows] @ own[:, number]
                seen |= got
            depth, step = until, 2 * step
            top, low = (self.values[:, i].astype(kind)[:, None] for i in (n - depth, depth - 1))  # what an unseen component is at most, or at least
            hidden = (~seen_top[rows]).astype(kind), (~seen_low[rows]).astype(kind)
            upper = known[rows] + hidden[0] @ (up[:, number] * top) + hidden[1] @ (down[:, number] * low)
            lower = known[rows] + hidden[0] @ (up[:, number] * ends[:, :1]) + hidden[1] @ (down[:, number] * ends[:, 1:])
            for at in range(len(number)):
                own = np.flatnonzero(alive[rows, at])
                if len(own) > k:
                    limit = np.partition(lower[own, at], len(own) - k)[len(own) - k]
                    alive[rows[own[upper[own, at] < limit]], at] = False  # an equal score may still win by its id


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of rows of one vector length; of rows that share an id the one with the smallest vector."""
    ids = rows.column("vec_id").to_numpy()
    vectors = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return ids[first], vectors[first]


def _search(k: int, at_once: int = 256):
    """The best ``k`` of one block of vectors for each of one block of queries."""

    def run(tile: pa.Table) -> pa.Table:
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        asks = tile.column("asks")
        queries, vectors = tile.filter(asks), tile.filter(pa.compute.invert(asks))
        if vectors.num_rows and queries.num_rows:
            lists = Lists(*_matrix(vectors))
            ids, asked = _matrix(queries)
            for at in range(0, len(ids), at_once):
                out += lists.search(ids[at:at + at_once], asked[at:at + at_once], k)
        none = np.zeros(0, np.int64)
        return pa.table({"query_id": np.repeat(np.array([x[0] for x in out], np.int64), [len(x[1]) for x in out]),
                         "vec_id": np.concatenate([none, *(x[1] for x in out)]).astype(np.int64),
                         "score": np.concatenate([none, *(x[2] for x in out)]).astype(np.int64)})

    return run


def exact_top_k(vectors: DataFrame, k: int = K, scale: int = SCALE, every: int = 50, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of ``vectors`` (``vec_id``, ``embedding``) with the highest inner product.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; a query's own ``vec_id`` is no candidate.  A
    component x counts as floor(scale * x).  Rows with a null ``vec_id``, a null vector, or null or non-finite components
    take no part; vectors of different lengths do not meet, and all scores of empty vectors are 0.  Of rows that share a
    ``vec_id`` (and a length) the one with the smallest vector stands.  An empty table gives an empty result.  Other
    columns are ignored.
    """
    spark = vectors.sparkSession
    workers_import(spark)
    finite = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")) \
        .filter(F.col("vec_id").isNotNull() & finite) \
        .select("vec_id", F.transform("embedding", lambda x: F.floor(x * scale)).alias("vector"), F.size("embedding").alias("dim"))
    is_query = F.col("vec_id") % every == 0
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n / block)).cast("int")
    sizes = table.groupBy("dim").agg(parts(F.count("*")).alias("blocks"), parts(F.count_if(is_query)).alias("parts"))
    dealt = table.join(F.broadcast(sizes), "dim") \
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("long")).withColumn("part", F.pmod(F.hash("vec_id"), "parts").cast("long"))  # a row of `sizes` for each vector length
    every_one = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n).cast("long") - 1))
    stored = dealt.select("dim", "block", every_one("parts").alias("part"), "vec_id", "vector", F.lit(False).alias("asks"))
    asked = dealt.filter(is_query).select("dim", every_one("blocks").alias("block"), "part", "vec_id", "vector", F.lit(True).alias("asks"))
    met = stored.unionByName(asked).groupBy("dim", "block", "part").applyInArrow(_search(k), "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
