"""Delivery audit of an unbounded step log.

A message that was received must be published within a period.  The received steps, each message once, meet the published
steps in a stream-stream outer join on the message and the time between the two.  State is kept until the watermark, which
any step moves, shows that no publication in time can come any more; a message without one is then reported, once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpublished_stream(steps: DataFrame, period: str, delay: str = "0 seconds", key: str = "msg_hash", ts_col: str = "ts") -> DataFrame:
    """``<key>, received_ts, due``: messages received and not published within ``period`` (append mode).

    ``steps`` has ``key``, ``ts_col`` and ``step`` (``received``, ``published``, others).  Redeliveries of a message within ``period``
    and ``delay`` count once; a publication after ``due`` is too late and does not take the report back; one that comes again
    changes nothing.
    """
    # every step moves the watermark; the conditions name its column, or they would be pushed below it
    timed = steps.withWatermark(ts_col, f"{period} {delay}")
    of_step = lambda name: F.when(F.col(ts_col).isNotNull(), F.col("step") == name)
    received = timed.where(of_step("received")).select(F.col(key), F.col(ts_col).alias("received_ts")).dropDuplicatesWithinWatermark([key])
    published = timed.where(of_step("published")).select(F.col(key).alias("_key"), F.col(ts_col).alias("_published"))
    due = F.col("received_ts") + F.expr(f"INTERVAL {period}")
    in_time = (F.col(key) == F.col("_key")) & (F.col("_published") >= F.col("received_ts")) & (F.col("_published") <= due)
    return received.join(published, in_time, "left_outer").where("_key IS NULL").select(key, "received_ts", due.alias("due"))


def unpublished(steps: DataFrame, period: str, key: str = "msg_hash", ts_col: str = "ts") -> DataFrame:
    """The same for a whole step log: one groupBy, with the first receipt and the first publication of each message."""
    first = steps.groupBy(key).agg(F.min(F.when(F.col("step") == "received", F.col(ts_col))).alias("received_ts"),
                                   F.min(F.when(F.col("step") == "published", F.col(ts_col))).alias("_published"))
    due = F.col("received_ts") + F.expr(f"INTERVAL {period}")
    return first.where(F.col("received_ts").isNotNull() & (F.col("_published").isNull() | (F.col("_published") > due))).select(key, "received_ts", due.alias("due"))
