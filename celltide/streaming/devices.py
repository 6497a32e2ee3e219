"""Devices online and offline, as a stream.

A device is online from its first message until ``period`` has passed without one.  In a stream this is a session
window: the state holds a row for each device that is online, and a device's row goes when the watermark passes the end of
its session, which is then emitted, once.  So the state follows the number of devices that are online and not of all that
were ever seen.  The session also carries the newest value of each field, with its time; ``merged_shadows`` makes the shadow
of all sessions from them, field by field, so that a field the last session did not send keeps its older value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _newest(fields: tuple[str, ...], ts_col: str) -> list[Column]:
    """``f_<field>``: (ts, seq, value) of the newest message that has the field."""
    obj, out = F.col("obj"), []
    for f in fields:
        value = F.struct(F.col(ts_col).alias("ts"), F.col("seq").alias("seq"), F.try_element_at(obj, F.lit(f)).cast("string").alias("value"))
        out.append(F.max_by(value, F.when(F.map_contains_key(obj, f), F.struct(ts_col, "seq"))).alias(f"f_{f}"))
    return out


def device_sessions_stream(decoded_good: DataFrame, period: str, delay: str = "0 seconds", fields: tuple[str, ...] = (),
                           ts_col: str = "publish_time") -> DataFrame:
    """``id, online_from, last_seen, offline_at, n_messages, f_<field>...``: each session once it has ended (append mode)."""
    rows = decoded_good.withWatermark(ts_col, delay).groupBy(F.session_window(ts_col, period).alias("s"), F.col("row_key").alias("id")) \
        .agg(F.max(ts_col).alias("last_seen"), F.count(F.lit(1)).alias("n_messages"), *_newest(fields, ts_col))
    return rows.select("id", F.col("s.start").alias("online_from"), "last_seen", F.col("s.end").alias("offline_at"), "n_messages", *(f"f_{f}" for f in fields))


def device_sessions(decoded_good: DataFrame, period: str, fields: tuple[str, ...] = (), ts_col: str = "publish_time") -> DataFrame:
    """The same for a batch, sessions that have not ended among them.

    Messages of a device within one aligned stretch of ``period`` are in one session, so they are aggregated first, map-side;
    what is left of a hot device is a row for each stretch, and gaps between these make the sessions.
    """
    gap = F.expr(f"INTERVAL {period}")
    stretch = F.window(ts_col, period).start
    rows = decoded_good.where(F.col(ts_col).isNotNull()).groupBy(F.col("row_key").alias("id"), stretch.alias("at")) \
        .agg(F.min(ts_col).alias("first"), F.max(ts_col).alias("last"), F.count(F.lit(1)).alias("n"), *_newest(fields, ts_col))
    order = Window.partitionBy("id").orderBy("at")
    opens = F.when(F.col("first") > F.lag("last").over(order) + gap, 1).otherwise(0)
    numbered = rows.withColumn("opens", opens).withColumn("session", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("id", "session") \
        .agg(F.min("first").alias("online_from"), F.max("last").alias("last_seen"), F.sum("n").alias("n_messages"), *(F.max(f"f_{f}").alias(f"f_{f}") for f in fields)) \
        .select("id", "online_from", "last_seen", (F.col("last_seen") + gap).alias("offline_at"), "n_messages", *(f"f_{f}" for f in fields))


def offline_intervals(sessions: DataFrame) -> DataFrame:
    """``id, offline_from, offline_until``: between sessions of a device; ``offline_until`` is NULL after its last one."""
    following = F.lead("online_from").over(Window.partitionBy("id").orderBy("online_from"))
    return sessions.select("id", F.col("offline_at").alias("offline_from"), following.alias("offline_until"))


def active_at(sessions: DataFrame, now: Column) -> DataFrame:
    """``id, last_seen, active``: whether a session of the device holds ``now``; ``last_seen`` is that of its newest session."""
    return sessions.groupBy("id").agg(F.max("last_seen").alias("last_seen"), F.bool_or((F.col("online_from") <= now) & (now <= F.col("offline_at"))).alias("active"))


def merged_shadows(sessions: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The shadow of each device over all its sessions: newest value of each field, last seen, number of messages."""
    newest = sessions.groupBy("id").agg(F.max("last_seen").alias("last_seen"), F.sum("n_messages").alias("n_messages"), *(F.max(f"f_{f}").alias(f"f_{f}") for f in fields))
    return newest.select("id", "last_seen", "n_messages", *(F.col(f"f_{f}")["value"].alias(f"f_{f}") for f in fields))
