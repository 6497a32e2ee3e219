"""Event-time windows, lateness and de-duplication.

The same functions serve batch frames and streaming frames; the streaming
wrappers in ``celltide.streaming`` add watermarks and sinks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltide.storage import shared_root


def tumbling(df: DataFrame, ts_col: str = "publish_time", size: str = "3 seconds",
             keys: tuple[str, ...] = ("relation",), value: Column | None = None) -> DataFrame:
    """Epoch-aligned tumbling windows per key: count, min, max, sum of ``value``."""
    v = value if value is not None else F.lit(None).cast("double")
    return (df.groupBy(F.window(ts_col, size).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("min_value"),
                 F.max(v).alias("max_value"), F.sum(v).alias("sum_value"))
            .select(F.col("w.start").alias("window_start"), *keys, "n", "min_value", "max_value",
                    "sum_value"))


def window_rows(df: DataFrame, ts_col: str = "publish_time", size: str = "3 seconds",
                keys: tuple[str, ...] = ("relation",), id_col: str = "seq") -> DataFrame:
    """A1: all ids of each (window, key) group, in order: one row for each group."""
    return (df.groupBy(F.window(ts_col, size).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(id_col)),
                                          lambda x: x.cast("string")), ",").alias("ids"))
            .select(F.col("w.start").alias("window_start"), *keys, "n", "ids"))


def window_chunks(df: DataFrame, ts_col: str = "publish_time", size: str = "3 seconds", keys: tuple[str, ...] = ("relation",),
                  order_col: str = "seq", values: tuple[str, ...] = (), rows: int = 10_000) -> DataFrame:
    """A1 for groups of any size: ``window_start, <keys>, n, chunk, items``.

    A group's rows, in ``order_col``, come in chunks of ``rows`` rows numbered from 0; ``items`` holds ``order_col`` and the
    ``values``, and ``n`` is the size of the whole group.  Rows are range-partitioned by (group, order), so a large group
    lies in several parts; a row's number is its place within its part and the sizes of the group's parts before.  No task
    holds more than its part's rows, or a chunk.
    """
    shared_root(df.sparkSession)
    group = ["window_start", *keys]
    order = [*group, order_col]
    named = df.select(F.window(ts_col, size).start.alias("window_start"), *keys, order_col, *values).where("window_start IS NOT NULL")
    placed = named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    # the id is the part's number << 33 and the row's place in it
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    parts = placed.groupBy(*group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(*group)
    before = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*(F.col(c).alias(f"_{c}") for c in (*group, "_part")), "_first",
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(own).alias("n"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*group, "_part")]
    number = F.col("_before") + F.col("_place") - F.col("_first")
    numbered = placed.join(parts, same).withColumn("chunk", F.floor(number / rows))
    item = F.struct(F.col("_place"), F.struct(order_col, *values).alias("item"))
    chunks = numbered.groupBy(*group, "n", "chunk").agg(F.sort_array(F.collect_list(item)).alias("_items"))  # at most ``rows`` of them
    return chunks.select(*group, "n", "chunk", F.transform("_items", lambda x: x["item"]).alias("items"))


def exclusive_running_max(df: DataFrame, order_col: str, val_col: str, out_col: str) -> DataFrame:
    """``out_col`` = max of ``val_col`` over all rows with a smaller ``order_col``.

    Rows are range-partitioned by ``order_col``, so each part holds about as
    many rows whatever the values are, and written to the shared folder with
    their part.  Each part gets a running max of its own rows, and the max
    over the parts before it: a window over one row for each part.
    """
    shared_root(df.sparkSession)
    rows = df.repartitionByRange(order_col).withColumn("_part", F.spark_partition_id()).checkpoint()
    parts = rows.groupBy("_part").agg(F.max(val_col).alias("_max"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.max("_max").over(earlier).alias("_prior"))
    within = Window.partitionBy("_part").orderBy(order_col).rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_own", F.max(val_col).over(within)).join(parts, "_part", "left")
    return rows.withColumn(out_col, F.greatest("_own", "_prior")).drop("_part", "_own", "_prior")


def late_flags(df: DataFrame, order_col: str, ts_col: str, delay_seconds: float = 0.0) -> DataFrame:
    """Mark rows whose event time is behind the watermark when they arrive.

    Watermark at a row = max event time of all rows that arrived before it,
    minus ``delay_seconds`` (engine default: no allowed lateness).  Adds
    ``watermark`` and ``is_late``; late rows are flagged, not dropped, so a
    caller can send them to a side output.
    """
    rows = exclusive_running_max(df, order_col, ts_col, "watermark")
    if delay_seconds:
        rows = rows.withColumn("watermark", F.col("watermark") - F.make_interval(secs=F.lit(delay_seconds)))
    return rows.withColumn("is_late", F.coalesce(F.col(ts_col) < F.col("watermark"), F.lit(False)))


def dedup(df: DataFrame, keys: tuple[str, ...] = ("message_id",)) -> DataFrame:
    """T8 (batch form): one row per message id; a redelivery adds nothing."""
    return df.dropDuplicates(list(keys))
