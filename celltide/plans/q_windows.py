"""Windowed and ordering queries: tumbling windows, window rows, lateness, dedup."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltide.operators import decode as D
from celltide.operators import windows as W
from celltide.plans.registry import query
from celltide.sources import catalog as K
from celltide.sources import fixtures as X


def _decoded(spark, sf_dir):
    return D.good(D.decode(X.messages(X.load_events(spark, sf_dir)), K.default_catalog()))


def _value():
    return F.try_element_at(F.col("obj"), F.lit("value")).try_cast("double")


@query("tumbling", """
SELECT time_bucket(INTERVAL '3 seconds', ts) AS window_start, event_type AS relation,
       CAST(count(*) AS BIGINT) AS n, min(value) AS min_value, max(value) AS max_value,
       round(sum(value), 6) AS sum_value
FROM events GROUP BY 1, 2""")
def q_tumbling(spark, sf_dir):
    """T2 + T4: 3-second tumbling windows on publish time, per relation."""
    t = W.tumbling(_decoded(spark, sf_dir), "publish_time", "3 seconds", ("relation",), _value())
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "relation", "n",
                    "min_value", "max_value", F.round("sum_value", 6).alias("sum_value"))


@query("window_rows", """
SELECT time_bucket(INTERVAL '3 seconds', ts) AS window_start, event_type AS relation,
       CAST(count(*) AS BIGINT) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
FROM events GROUP BY 1, 2""")
def q_window_rows(spark, sf_dir):
    """A1: every message id of each (window, relation), in order."""
    t = W.window_rows(_decoded(spark, sf_dir), "publish_time", "3 seconds", ("relation",), "seq")
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "relation",
                    "n", "ids")


@query("window_chunks", """
WITH r AS (SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, event_type AS relation, event_id, value,
                  row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts), event_type ORDER BY event_id) - 1 AS number,
                  count(*) OVER (PARTITION BY time_bucket(INTERVAL '1 day', ts), event_type) AS n FROM events)
SELECT window_start, relation, CAST(n AS BIGINT) AS n, CAST(number // 25 AS BIGINT) AS chunk,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids, round(sum(value), 6) AS sum_value
FROM r GROUP BY 1, 2, 3, 4""")
def q_window_chunks(spark, sf_dir):
    """A1: the rows of each (day, relation) in numbered chunks of 25, so that a group may be of any size."""
    msgs = _decoded(spark, sf_dir).withColumn("value", _value())
    t = W.window_chunks(msgs, size="1 day", values=("value",), rows=25)
    ids = F.array_join(F.transform("items", lambda x: x["seq"].cast("string")), ",")
    total = F.aggregate("items", F.lit(0.0), lambda a, x: a + x["value"])
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "relation", "n", "chunk", ids.alias("ids"), F.round(total, 6).alias("sum_value"))


@query("late_split", """
WITH a AS (SELECT event_id, ts,
                  CASE WHEN event_id % 50 = 0 THEN event_id * 2 + 41 ELSE event_id * 2 END AS arrival
           FROM events)
SELECT event_id,
       coalesce(ts < max(ts) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)
         AS is_late
FROM a""")
def q_late_split(spark, sf_dir):
    """Rows behind the watermark (max event time seen so far, no allowed
    lateness) at their arrival; rows with ``event_id % 50 = 0`` arrive 20 late."""
    msgs = X.messages(X.load_events(spark, sf_dir)).withColumn("arrival", X.arrival_order("seq"))
    flagged = W.late_flags(msgs, "arrival", "publish_time", 0.0)
    return flagged.select(F.col("seq").alias("event_id"), "is_late")


@query("dedup", "SELECT event_id FROM events")
def q_dedup(spark, sf_dir):
    """Redelivered messages (``event_id % 10 = 0`` twice) kept once."""
    msgs = X.duplicated_messages(X.load_events(spark, sf_dir))
    return W.dedup(msgs, ("message_id",)).select(F.col("seq").alias("event_id"))


@query("stream_tumbling", """
SELECT time_bucket(INTERVAL '3 seconds', ts) AS window_start, event_type AS relation,
       CAST(count(*) AS BIGINT) AS n, min(value) AS min_value, max(value) AS max_value,
       round(sum(value), 6) AS sum_value
FROM events GROUP BY 1, 2""")
def q_stream_tumbling(spark, sf_dir):
    """T2-T4 under Structured Streaming: 3-second windows on publish time with a
    watermark (no allowed lateness), update mode.  Messages arrive in time
    order (8-day slices, or wider ones over a long time, one per micro-batch), so no row is
    behind the watermark of an earlier micro-batch and every window is complete."""
    from celltide.storage import new_location
    from celltide.streaming import sources as SS
    from celltide.streaming import stateful as ST
    landing = new_location(spark, "landing")
    each = SS.land_in_time_order(X.messages(X.load_events(spark, sf_dir)), landing, days_per_slice=8)
    stream = D.good(D.decode(SS.landed_messages(spark, f"{landing}/*", each), K.default_catalog()))
    out = new_location(spark, "stream-windows")
    q = ST.start_window_updates(ST.tumbling_stream(stream, value=_value()), out, new_location(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    t = ST.latest_window_updates(spark, out, ["window_start", "relation"])
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "relation", "n",
                    "min_value", "max_value", F.round("sum_value", 6).alias("sum_value"))


@query("stream_dedup", "SELECT event_id FROM events")
def q_stream_dedup(spark, sf_dir):
    """T8 under Structured Streaming: redelivered messages (``event_id % 10 = 0``
    twice) arrive in time order; ``dropDuplicatesWithinWatermark`` (1 hour)
    keeps each message id once, written through the exactly-once file sink."""
    from celltide.storage import new_location
    from celltide.streaming import sources as SS
    from celltide.streaming import stateful as ST
    landing = new_location(spark, "landing")
    each = SS.land_in_time_order(X.duplicated_messages(X.load_events(spark, sf_dir)).drop("copy"), landing,
                          days_per_slice=8)
    d = ST.dedup_stream(SS.landed_messages(spark, f"{landing}/*", each), delay="1 hour")
    out = new_location(spark, "stream-dedup")
    q = (d.writeStream.format("parquet").option("checkpointLocation", new_location(spark, "stream-ckpt"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(SS.MESSAGE_SCHEMA).parquet(out).select(F.col("seq").alias("event_id"))


@query("stream_late", """
WITH a AS (SELECT event_id, ts,
                  CASE WHEN event_id % 50 = 0 THEN event_id * 2 + 41 ELSE event_id * 2 END AS arrival
           FROM events),
w AS (SELECT CAST(ceil((max(arrival) + 1) / 1000.0) AS BIGINT) * 100 AS width FROM a),
s AS (SELECT a.event_id, a.ts, (a.arrival + 80) // w.width AS slice FROM a, w),
m AS (SELECT slice, max(ts) AS mx FROM s GROUP BY slice),
p AS (SELECT slice, max(mx) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM m)
SELECT event_id, coalesce(ts < prev, false) AS is_late FROM s JOIN p USING (slice)""")
def q_stream_late(spark, sf_dir):
    """T3 under Structured Streaming with a side output: messages arrive in
    ``late_split``'s arrival order in 10 slices (one micro-batch each); a row
    behind the max event time of the earlier micro-batches goes to the late
    table instead of being dropped."""
    from celltide.storage import new_location
    from celltide.streaming import late as LT
    from celltide.streaming import sources as SS
    msgs = X.messages(X.load_events(spark, sf_dir)).withColumn("arrival", X.arrival_order("seq"))
    span = msgs.select(F.max("arrival")).first()[0] + 1  # one scalar
    # about 10 slices; the width is a multiple of 100 arrival slots and the
    # boundaries are shifted by 80, so each boundary falls inside the 41-slot
    # delay of one delayed message (which then arrives one micro-batch late)
    width = -(-span // 1000) * 100
    landing = new_location(spark, "landing")
    each = SS.land_in_slices(msgs.drop("arrival"), landing,
                      F.floor((X.arrival_order("seq") + 80) / width))
    path = new_location(spark, "late-split")
    stream = SS.landed_messages(spark, f"{landing}/*", each)
    q = LT.start_late_split(stream, "publish_time", path, new_location(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    LT.join_batches(spark, path, stream.schema, ["batch_id"])
    return LT.split_rows(spark, path, stream.schema).select(F.col("seq").alias("event_id"), F.col("late").alias("is_late"))


@query("stream_tumbling_append", """
WITH a AS (SELECT event_id, ts, event_type, value, time_bucket(INTERVAL '3 seconds', ts) AS w,
                  CASE WHEN event_id % 50 = 0 THEN event_id * 2 + 41 ELSE event_id * 2 END AS arrival FROM events),
wd AS (SELECT CAST(ceil((max(arrival) + 1) / 1000.0) AS BIGINT) * 100 AS width FROM a),
s AS (SELECT a.*, (a.arrival + 80) // wd.width AS slice FROM a, wd),
m AS (SELECT slice, max(ts) AS mx FROM s GROUP BY slice),
l AS (SELECT slice, max(mx) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS closed FROM m)
SELECT w AS window_start, event_type AS relation, CAST(count(*) AS BIGINT) AS n,
       min(value) AS min_value, max(value) AS max_value, round(sum(value), 6) AS sum_value
FROM s JOIN l USING (slice)
WHERE (closed IS NULL OR w + INTERVAL 3 SECOND > closed) AND w + INTERVAL 3 SECOND <= (SELECT max(ts) FROM events)
GROUP BY 1, 2""")
def q_stream_tumbling_append(spark, sf_dir):
    """T3 as an engine runs it: append mode fires each window once, when the watermark (no allowed lateness) has passed
    its end; rows for a window that has fired are dropped, and windows that are still open do not appear.
    Messages arrive in ``late_split``'s order in 10 slices, one to a micro-batch."""
    from celltide.storage import new_location
    from celltide.streaming import sources as SS
    from celltide.streaming import stateful as ST
    msgs = X.messages(X.load_events(spark, sf_dir))
    span = msgs.select(F.max(X.arrival_order("seq"))).first()[0] + 1  # one scalar
    landing, out = new_location(spark, "landing"), new_location(spark, "stream-windows")
    each = SS.land_in_slices(msgs, landing, F.floor((X.arrival_order("seq") + 80) / (-(-span // 1000) * 100)))
    stream = D.good(D.decode(SS.landed_messages(spark, f"{landing}/*", each), K.default_catalog()))
    q = (ST.tumbling_stream(stream, value=_value()).writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", new_location(spark, "stream-ckpt")).trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    t = spark.read.schema("window_start TIMESTAMP, relation STRING, n BIGINT, min_value DOUBLE, max_value DOUBLE, sum_value DOUBLE").parquet(out)
    return t.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "relation", "n",
                    "min_value", "max_value", F.round("sum_value", 6).alias("sum_value"))
