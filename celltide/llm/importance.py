"""Target-distribution importance resampling over hashed word n-grams.

Separators of a text (ASCII other than letters and digits) are collapsed to single spaces, with A-Z as a-z.  An overlapped
regular expression with a boundary before and after then gives the span of every run of n words, and the CRC-32 of the
span's bytes modulo ``buckets`` is the feature's bucket.  Each document's buckets are written once (two bytes a feature);
their totals over all documents and over the target give every bucket a gain, the log ratio of the two smoothed
distributions.  A document's weight is the floored mean of its gains, and its score adds Gumbel noise drawn from a hash
of its id, so that the highest scores are a sample without replacement in proportion to the weights.

Ranks come from one range partitioning by score: each row's place within its range, and the sizes of the ranges before.

Defined results: a null or empty text has no features and weight 0.  A null ``doc_id`` has the noise of the empty id and
comes last among ties.  Rows that repeat give a row each, with ranks of their own; of rows with one score and ``doc_id``
the one with more features comes first.  Empty tables give an empty result, or weights against an empty target.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.llm.common import pieces_of, staged, staged_at, workers_import
from celltide.storage import delete_path

NGRAMS, BUCKETS, PERCENT, LEAST_WORDS, SEED = (1, 1), 10_000, 10, 20, 2024
#: Largest number of buckets: their totals and gains are a row each on the driver and in every task.
MOST_BUCKETS = 1 << 24
_COLLAPSE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _pattern(n: int) -> regex.Pattern:
    """A run of ``n`` words between single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _features(ngrams: tuple[int, int], buckets: int):
    """Words and buckets of each text; a feature that stands twice is there twice."""
    patterns, kind = [_pattern(n) for n in range(ngrams[0], ngrams[1] + 1)], _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in pieces_of(batch, "text"):
                words, features = [], []
                for value in values:
                    line = b" ".join(value.as_py().lower().translate(_COLLAPSE).split())
                    words.append(line.count(b" ") + 1 if line else 0)
                    features.append(b"".join(np.fromiter((zlib.crc32(m.group()) % buckets for m in p.finditer(line, overlapped=True)), kind).tobytes() for p in patterns))
                yield pa.record_batch([rows.column("doc_id"), pa.array(words, pa.int64()), pa.array(features, pa.binary()), rows.column("rest")],
                                      names=["doc_id", "n_words", "features", "rest"])

    return run


def _totals(buckets: int):
    """(bucket, n) of one task's features."""
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column("features"):
                held += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(held[some])], names=["bucket", "n"])

    return run


def _counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; at most ``buckets`` rows reach the driver."""
    found = features.select("features").mapInArrow(_totals(buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of the smoothed distributions of ``target`` and ``own``."""
    n, all_own, all_target = len(own), float(own.sum() + len(own)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log(float(target[i] + 1) * all_own / (float(own[i] + 1) * all_target))) for i in range(n)], np.int64)


def _noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(sent, buckets: int, seed: int):
    kind = _kind(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for batch in batches:
            size, weight = [], []
            for value in batch.column("features"):
                own = np.frombuffer(value.as_buffer(), kind)
                size.append(len(own))
                weight.append(int(gain[own].sum()) // len(own) if len(own) else 0)
            score = [w + _noise(seed, d) for w, d in zip(weight, batch.column("doc_id").to_pylist())]
            yield pa.record_batch([batch.column("doc_id"), batch.column("n_words"), *(pa.array(x, pa.int64()) for x in (size, weight, score)), batch.column("rest")],
                                  names=["doc_id", "n_words", "n_features", "weight", "score", "rest"])

    return run


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``rank`` (long, from 1) in ``order``, and ``ranked_rows``, their number.

    ``rows`` is a table that may be read twice.  The sums run over one row for each range, whatever the number of rows.
    """
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "places")
    # the id is the partition's number << 33 and the row's place in it
    part, place = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy()).alias("ranked_rows"))
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("rank", F.col("offset") + place + 1).drop("part", "offset", "place")


def resample(docs: DataFrame, target: DataFrame, ngrams: tuple[int, int] = NGRAMS, buckets: int = BUCKETS, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank, rest) for each row of ``docs`` (``doc_id``, ``text``).

    Features are the runs of ``ngrams[0]`` to ``ngrams[1]`` words.  Of the documents with ``least_words`` words or more the
    ``percent`` % with the highest scores are drawn: they have a rank from 1, ties to the smaller ``doc_id``; the others
    have none.  ``target`` needs ``text`` only.  ``carry`` names columns to return beside the result, as the struct ``rest``.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets is 1 to {MOST_BUCKETS}, not {buckets}")
    spark = docs.sparkSession
    workers_import(spark)
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    rest = (F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.lit(None).cast("string")).alias("rest")
    table = docs.select(doc_id, text, rest)
    kept = table.schema["rest"].dataType

    def kinds(ddl: str) -> T.StructType:
        return T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField("rest", kept)])

    find = _features(ngrams, buckets)
    found, path = staged_at(table.mapInArrow(find, kinds("doc_id long, n_words long, features binary")), "features")
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), text, F.lit(None).cast("string").alias("rest")) \
        .mapInArrow(find, "doc_id long, n_words long, features binary, rest string")
    gain = spark.sparkContext.broadcast(gains(_counts(found, buckets), _counts(wanted, buckets)))
    scored = staged(found.mapInArrow(_score(gain, buckets, seed), kinds("doc_id long, n_words long, n_features long, weight long, score long")), "scores")
    delete_path(spark, path)
    enough = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.desc("n_words"))
    drawn = F.expr(f"rank <= ranked_rows * {int(percent)} div 100")
    chosen = ranked(scored.filter(enough), *order).withColumn("rank", F.when(drawn, F.col("rank"))).drop("ranked_rows")
    out = chosen.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank", "rest")


def draw(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, whole and with their columns."""
    return resample(docs, target, carry=tuple(docs.columns), **parameters).filter("rank is not null").select("rest.*")
