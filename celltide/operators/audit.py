"""Bounded reads and order-free comparison of message sets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from celltide.operators import table_log as TL
from celltide.storage import delete_path, new_location

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def bounded_read(messages: DataFrame, n: int, order_col: str = "seq") -> DataFrame:
    """The first ``n`` messages in source order (top-n, not a full sort)."""
    return messages.orderBy(order_col).limit(n)


def read_next(messages: DataFrame, path: str, n: int, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The next ``n`` messages in ``order``, which must tell them apart; committed to the table at ``path`` with how far they reach.

    The rows and the position go into one commit of the write log, so a run that breaks off has read nothing, and no
    message is in two runs or in none.  The result is what this run committed; ``all_read`` has all runs.
    """
    spark, columns = messages.sparkSession, messages.columns
    now = TL.snapshot(spark, path)
    run, last = now.marks.get("run", -1) + 1, now.marks.get("position")
    place = F.struct(*order)
    left = messages
    if last is not None:
        kind = StructType([messages.schema[c] for c in order])
        left = left.where(place > F.from_json(F.lit(last), kind, {"timestampFormat": _MICROS}))
        if messages.schema[order[0]].dataType.typeName() in ("long", "integer"):  # reaches the scan
            left = left.where(F.col(order[0]) >= F.lit(json.loads(last)[order[0]]))
    stage = new_location(spark, "next")
    left.orderBy(*order).limit(n).write.parquet(stage)
    rows = spark.read.schema(messages.schema).parquet(stage)
    reached = rows.agg(F.to_json(F.max(place), {"timestampFormat": _MICROS})).first()[0]
    folders = TL.append(rows.withColumn("run", F.lit(run)), path, ["run"], f"run-{run}", {"run": run, "position": reached}) if reached is not None else []
    delete_path(spark, stage)
    return TL.read(spark, path, messages.schema, folders=folders).select(*columns)


def all_read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The messages of all runs of ``read_next``, with their ``run``."""
    return TL.read(spark, path, StructType([*schema.fields, StructField("run", LongType())]))


def multiset_diff(sent: DataFrame, received: DataFrame, key: str = "msg_hash") -> DataFrame:
    """Keys whose multiplicity differs between the two sides.

    One union and one partially aggregated ``groupBy`` (no join): an empty
    result means the two multisets are equal.
    """
    a = sent.select(F.col(key), F.lit(1).alias("s"), F.lit(0).alias("r"))
    b = received.select(F.col(key), F.lit(0).alias("s"), F.lit(1).alias("r"))
    return (a.unionByName(b).groupBy(key)
            .agg(F.sum("s").alias("sent"), F.sum("r").alias("received"))
            .where(F.col("sent") != F.col("received")))
