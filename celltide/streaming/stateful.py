"""Stateful streaming forms: tumbling windows, de-duplication, device shadow.

All use built-in state operators (no Python state functions).  Event time
must be a ``timestamp`` column (not ``timestamp_ntz``) in a UTC session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from celltide.operators import shadow as SH
from celltide.operators import windows as W


def tumbling_stream(decoded: DataFrame, ts_col: str = "publish_time", size: str = "3 seconds",
                    delay: str = "0 seconds", keys: tuple[str, ...] = ("relation",),
                    value: Column | None = None) -> DataFrame:
    """Windows close when the watermark (max event time - ``delay``)
    passes their end; in append mode each window is emitted once and rows
    behind the watermark are dropped (the engine default of the reference)."""
    return W.tumbling(decoded.withWatermark(ts_col, delay), ts_col, size, keys, value)


def window_rows_stream(decoded: DataFrame, ts_col: str = "publish_time", size: str = "3 seconds",
                       delay: str = "0 seconds", keys: tuple[str, ...] = ("relation",),
                       id_col: str = "seq") -> DataFrame:
    """A1 in a stream: the ids of each (window, key) group, emitted once when
    the watermark closes the window (append mode)."""
    return W.window_rows(decoded.withWatermark(ts_col, delay), ts_col, size, keys, id_col)


def dedup_stream(messages: DataFrame, ts_col: str = "publish_time", delay: str = "10 minutes",
                 keys: tuple[str, ...] = ("message_id",)) -> DataFrame:
    """Drop redeliveries of a message id seen within the watermark delay;
    state for an id is released once the watermark passes it."""
    return messages.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(list(keys))


def shadow_stream(decoded: DataFrame, fields: list[str], ts_col: str = "publish_time") -> DataFrame:
    """Running device shadow (``update`` output mode); state holds one row
    per device, the shadow itself."""
    return SH.device_shadow(decoded, fields, ts_col)


def start_window_updates(agg: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Run a streaming aggregate (windows, device shadow, ...) in ``update``
    mode; each micro-batch's updated groups go to ``path`` under its
    ``batch_id`` (dynamic overwrite, so a replay rewrites its own folder).
    Read with ``latest_window_updates``."""
    from pyspark.sql import functions as F

    def write(df, bid):
        (df.withColumn("batch_id", F.lit(bid)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))

    return (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def latest_window_updates(spark, path: str, keys: list[str]) -> DataFrame:
    """The last update of every group (one partially aggregated groupBy)."""
    latest = _latest(spark.read.parquet(path), keys)
    return latest.drop("batch_id")


def _latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    from pyspark.sql import functions as F
    vals = [c for c in updates.columns if c not in keys and c != "batch_id"]
    latest = updates.groupBy(*keys).agg(F.max_by(F.struct(*vals), "batch_id").alias("_v"), F.max("batch_id").alias("batch_id"))
    return latest.select(*keys, *[F.col("_v")[c].alias(c) for c in vals], "batch_id")


def fold_updates(spark, path: str, keys: list[str], until: int) -> None:
    """Replace the updates of the committed batches up to ``until`` by the last one of each group, kept as batch ``until``.

    Bounds the update log by the number of groups.  The folded updates are
    written before the old ones are removed, and a group's last update is the
    same with either, so a run that breaks off does no harm.
    """
    from pyspark.sql import functions as F
    from celltide.storage import delete_path, list_subdirs, new_location
    old = spark.read.parquet(path).where(F.col("batch_id") <= until)
    stage = new_location(spark, "folded")
    _latest(old, keys).withColumn("batch_id", F.lit(until)).write.parquet(stage)
    (spark.read.parquet(stage).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))
    for d in list_subdirs(spark, path):
        if d.startswith("batch_id=") and int(d.split("=", 1)[1]) < until:
            delete_path(spark, f"{path}/{d}")
    delete_path(spark, stage)
