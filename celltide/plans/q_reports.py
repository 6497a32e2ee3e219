"""Reports: delivery SLOs, device shadow, active devices, multiset comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltide.operators import audit as A
from celltide.operators import decode as D
from celltide.operators import logs as LG
from celltide.operators import shadow as SH
from celltide.operators import slo as SL
from celltide.plans import oracles as O
from celltide.plans.registry import query
from celltide.sources import catalog as K
from celltide.sources import fixtures as X

SAMPLES_CTE = """s AS (
  SELECT 'mqtt_message_duration' AS metric, value AS x FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'mqtt_message_bytes', CAST(length(props) * 2 AS DOUBLE) FROM events WHERE event_type <> 'error'
  UNION ALL SELECT 'iteration_duration', (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 FROM events GROUP BY user_id)"""

TREND_SQL = SAMPLES_CTE + """,
t AS (
  SELECT metric, CAST(count(x) AS BIGINT) AS n, round(avg(x), 6) AS avg, round(min(x), 6) AS min,
         round(quantile_cont(x, 0.5), 6) AS med, round(max(x), 6) AS max,
         round(quantile_cont(x, 0.9), 6) AS p90, round(quantile_cont(x, 0.95), 6) AS p95,
         round(quantile_cont(x, 0.99), 6) AS p99
  FROM s GROUP BY metric)"""


def _measures(spark, sf_dir):
    return X.delivery_measures(X.load_events(spark, sf_dir))


@query("slo_counters", """
WITH t AS (
  SELECT CAST(count(*) FILTER (WHERE event_type <> 'error') AS BIGINT) AS sent,
         CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed,
         CAST(count(DISTINCT user_id) AS BIGINT) AS conns,
         CAST(sum(length(props) * 2) FILTER (WHERE event_type <> 'error') AS BIGINT) AS data_sent,
         (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS elapsed
  FROM events)
SELECT metric, total, round(total / elapsed, 6) AS rate FROM (
  SELECT 'mqtt_calls' AS metric, sent + failed + conns AS total, elapsed FROM t
  UNION ALL SELECT 'mqtt_concurrent_connections', conns, elapsed FROM t
  UNION ALL SELECT 'mqtt_messages_sent', sent, elapsed FROM t
  UNION ALL SELECT 'mqtt_messages_failed', failed, elapsed FROM t
  UNION ALL SELECT 'iterations', conns, elapsed FROM t
  UNION ALL SELECT 'data_sent', data_sent, elapsed FROM t)""")
def q_slo_counters(spark, sf_dir):
    """A2: counters with totals and per-second rates over the run."""
    return SL.counters(_measures(spark, sf_dir))


@query("slo_trend", "WITH " + TREND_SQL + " SELECT * FROM t")
def q_slo_trend(spark, sf_dir):
    """A3 + A7 + A11: publish duration, payload bytes and iteration duration statistics."""
    return SL.trend(_measures(spark, sf_dir))


@query("slo_verdict", "WITH " + TREND_SQL + """
SELECT metric, rule, observed, threshold, observed < threshold AS passed FROM (
  SELECT metric, 'p(50)<200' AS rule, med AS observed, CAST(200 AS DOUBLE) AS threshold FROM t
  UNION ALL SELECT metric, 'p(95)<500', p95, CAST(500 AS DOUBLE) FROM t
  UNION ALL SELECT metric, 'p(99)<1000', p99, CAST(1000 AS DOUBLE) FROM t)
WHERE metric = 'mqtt_message_duration'""")
def q_slo_verdict(spark, sf_dir):
    """A4: thresholds p50<200, p95<500, p99<1000 on the publish duration."""
    return SL.verdict(SL.trend(_measures(spark, sf_dir)))


SHADOW_SQL = O.with_(O.EV) + """
SELECT row_key AS id, max(ts) AS last_seen, CAST(count(*) AS BIGINT) AS n_messages,
       arg_max_null(ts_text, (ts, event_id)) AS f_timestamp,
       arg_max_null(value_text, (ts, event_id)) FILTER (WHERE event_id % 5 <> 0) AS f_value,
       arg_max_null(CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END, (ts, event_id))
         FILTER (WHERE event_id % 7 = 0 OR event_id % 3 <> 0) AS f_k
FROM ev GROUP BY row_key"""


def _shadow(spark, sf_dir):
    msgs = D.good(D.decode(X.sparse_messages(X.load_events(spark, sf_dir)), K.default_catalog()))
    return SH.device_shadow(msgs, ["timestamp", "value", "k"])


@query("device_shadow", SHADOW_SQL)
def q_device_shadow(spark, sf_dir):
    """A10 + T7 (batch form): newest value of each field per device, last seen."""
    s = _shadow(spark, sf_dir)
    return s.select("id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), "n_messages",
                    "f_timestamp", "f_value", "f_k")


@query("active_devices", "WITH sh AS (" + SHADOW_SQL + """)
SELECT id, last_seen, last_seen >= (SELECT max(last_seen) FROM sh) - INTERVAL 6 HOUR AS active FROM sh""")
def q_active_devices(spark, sf_dir):
    """A10: devices seen within 6 hours of the newest sighting."""
    # "now" = newest message time, from a one-column scan (not a second shadow aggregation)
    now = F.lit(LG.newest(X.load_events(spark, sf_dir), "ts"))
    a = SH.active_devices(_shadow(spark, sf_dir), "6 hours", now)
    return a.select("id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), "active")


@query("multiset_diff", O.with_(O.EV) + f"""
SELECT md5({O.PAYLOAD}) AS msg_hash, CAST(1 AS BIGINT) AS sent,
       CAST(CASE WHEN event_id % 61 = 0 THEN 0 ELSE 2 END AS BIGINT) AS received
FROM ev WHERE event_id % 61 = 0 OR event_id % 67 = 0""")
def q_multiset_diff(spark, sf_dir):
    """X1 + O3: messages whose sent and received counts differ."""
    sent, received = X.sent_received(X.load_events(spark, sf_dir))
    return A.multiset_diff(sent, received, "msg_hash")


@query("stream_shadow", SHADOW_SQL)
def q_stream_shadow(spark, sf_dir):
    """T7 under Structured Streaming: the device shadow as a running aggregate
    (update mode, state = one row per device), micro-batches of 2 files (of half the
    files, at most ``BATCH_FILES``, of a large input); each batch's updated devices are
    written by batch id and the last update of every device is read back."""
    from celltide.storage import new_location
    from celltide.streaming import sources as SS
    from celltide.streaming import stateful as ST
    landing = new_location(spark, "landing")
    files = SS.land_messages(X.sparse_messages(X.load_events(spark, sf_dir)), landing, files=4)
    stream = D.good(D.decode(SS.landed_messages(spark, landing, SS.files_per_batch(files, 2)), K.default_catalog()))
    out = new_location(spark, "stream-shadow")
    q = ST.start_window_updates(ST.shadow_stream(stream, ["timestamp", "value", "k"]), out,
                                new_location(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    s = ST.latest_window_updates(spark, out, ["id"])
    return s.select("id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"), "n_messages",
                    "f_timestamp", "f_value", "f_k")


SKETCH_ERROR = 0.01

@query("slo_sketch", """
WITH c AS (SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN value = 0 THEN 0 ELSE CAST(ceil(ln(value) / ln(1.01 / 0.99)) AS BIGINT) END AS cell, count(*) AS n
           FROM events GROUP BY 1, 2),
u AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY cell) AS upto, sum(n) OVER (PARTITION BY day) AS total FROM c),
p(p) AS (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE))
SELECT day, p, CAST(total AS BIGINT) AS n, round(exp(cell * ln(1.01 / 0.99)) * 2 / (1 + 1.01 / 0.99), 6) AS value
FROM u, p WHERE floor(p * (total - 1)) < upto AND floor(p * (total - 1)) >= upto - n""")
def q_slo_sketch(spark, sf_dir):
    """A3: percentiles of the publish duration by day, from sketches of 15-minute intervals, built by a stream in update mode."""
    from celltide.operators import sketches as SK
    from celltide.storage import new_location
    from celltide.streaming import stateful as ST
    ev = X.load_events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), F.lit("mqtt_message_duration").alias("metric"), F.col("value").alias("x"))
    landing, out = new_location(spark, "samples"), new_location(spark, "sketches")
    ev.repartitionByRange(4, "ts").write.parquet(landing)
    stream = SK.interval_sketches_stream(spark.readStream.schema(ev.schema).parquet(landing), "15 minutes", error=SKETCH_ERROR)
    q = ST.start_window_updates(stream, out, new_location(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    stored = ST.latest_window_updates(spark, out, ["bucket", "metric", "cell"])
    days = SK.merged(stored, (F.date_format("bucket", "yyyy-MM-dd").alias("day"), "metric"))
    return SK.sketch_quantiles(days, ("day", "metric"), [0.5, 0.95, 0.99], SKETCH_ERROR).select("day", "p", "n", F.round("value", 6).alias("value"))
