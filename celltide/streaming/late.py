"""Late-row side output for streams.

Spark's stateful operators drop rows behind the watermark and only count
them.  This keeps them: each micro-batch is split into on-time and late rows
against the maximum event time of all *earlier* micro-batches (the watermark
with no allowed lateness, as the engine default of the reference).

On-time and late rows are two partitions (``late``) of one logged table, and
the high-water mark is committed with them: the rows of a batch, both kinds,
and how far event time has come appear together or not at all.  A repeated
batch reads the mark that it read before and replaces its rows.
``join_batches`` joins the folders of committed batches, so that their number
does not follow the number of micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from celltide.operators import table_log as TL
from celltide.streaming.ingest import query_id


def split_batch(batch: DataFrame, batch_id: int, ts_col: str, path: str, query: str, delay_seconds: float = 0.0) -> None:
    """Write one micro-batch of the stream ``query`` to the table at ``path``, with ``late`` and ``batch_id``."""
    spark = batch.sparkSession
    # per query: the last committed batch, and the newest event time (microseconds) before and after it
    last, before, after = TL.snapshot(spark, path).marks.get(query, [-1, None, None])
    if batch_id < last:
        raise ValueError(f"batch {batch_id} of {query} cannot be repeated: {last} is committed")
    newest = before if batch_id == last else after
    bound = F.timestamp_micros(F.lit(newest).cast("long")) - F.make_interval(secs=F.lit(delay_seconds))
    rows = batch.persist()
    try:
        late = F.coalesce(F.col(ts_col) < bound, F.lit(False)) if newest is not None else F.lit(False)
        own = rows.agg(F.unix_micros(F.max(ts_col))).first()[0]
        reached = max((x for x in (own, newest) if x is not None), default=None)
        split = rows.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("late", late)
        TL.append(split.hint("rebalance", "late"), path, ["late"], f"{query}-{batch_id}", {query: [batch_id, newest, reached]})
    finally:
        rows.unpersist()


def _schema(schema: StructType) -> StructType:
    extra = (("batch_id", LongType()), ("write", StringType()), ("late", BooleanType()))
    return StructType([*schema.fields, *(StructField(*x) for x in extra)])


def split_rows(spark: SparkSession, path: str, schema: StructType, late: bool | None = None) -> DataFrame:
    """The rows written so far, with ``batch_id`` and ``late``; only the late or the on-time ones if asked for."""
    keep = None if late is None else lambda p: p["late"] == str(late).lower()
    return TL.read(spark, path, _schema(schema), keep).drop("write")


def join_batches(spark: SparkSession, path: str, schema: StructType, order: list[str], ended: bool = False) -> int:
    """Join the folders of committed batches, but for the newest, which may be repeated; returns how many were made."""
    return TL.join_writes(spark, path, _schema(schema), ["late"], order, ended=ended)


def start_late_split(stream: DataFrame, ts_col: str, path: str, checkpoint: str, delay_seconds: float = 0.0,
                     trigger: dict | None = None) -> StreamingQuery:
    """Run ``split_batch`` on every micro-batch of ``stream``."""
    def run(df: DataFrame, batch_id: int) -> None:
        split_batch(df, batch_id, ts_col, path, query_id(df.sparkSession, checkpoint), delay_seconds)

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
            .trigger(**(trigger or {"availableNow": True})).start())
