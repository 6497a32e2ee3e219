"""Helpers shared by the corpus operators: staged tables and Arrow batch plumbing."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from celltide.storage import new_location

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_import(spark: SparkSession) -> None:
    """Put the library on the Python path of workers that this driver's context starts.

    A cluster has the library installed or shipped with ``--py-files``; this serves a driver that was
    started from another folder on the same file system.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, known) if x)


def staged(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: a lost executor repeats only what follows, and no costly step runs twice.
    """
    return staged_at(df, kind)[0]


def staged_at(df: DataFrame, kind: str) -> tuple[DataFrame, str]:
    """``staged`` and the folder, for a table that is deleted once it has been used."""
    spark = df.sparkSession
    path = new_location(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def pieces_of(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut a batch into runs of rows whose ``column`` (string or binary) holds about ``max_bytes``.

    Yields (rows, values of the column as a null-free binary array).  A value longer than the bound makes a run of
    its own; no value is cut.
    """
    values = batch.column(column)
    if not pa.types.is_large_binary(values.type):
        values = values.cast(pa.large_binary())
    values = values.fill_null(b"")
    lengths = pa.compute.binary_length(values).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and held + n > max_bytes:
            yield batch.slice(begin, i - begin), values.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < len(lengths):
        yield batch.slice(begin), values.slice(begin)


import pyarrow.compute  # noqa: E402,F401  (pa.compute)
