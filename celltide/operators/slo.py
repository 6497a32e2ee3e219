"""Delivery measures: counters, trends and threshold verdicts.

Input: ``delivery_measures`` rows ``(seq, ts, vu, duration_ms, bytes, sent,
failed)``.  Aggregation is two-level: per virtual user first (a keyed,
partially aggregated shuffle), then over the per-user rows, so no distinct
aggregate and no Expand of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.operators.quantiles import exact_percentiles, frequencies

PERCENTILES = [0.5, 0.9, 0.95, 0.99]

# Load-test thresholds on the publish duration (ms).
THRESHOLDS = [("mqtt_message_duration", "p(50)<200", "med", 200.0),
              ("mqtt_message_duration", "p(95)<500", "p95", 500.0),
              ("mqtt_message_duration", "p(99)<1000", "p99", 1000.0)]


def per_vu(measures: DataFrame) -> DataFrame:
    """One row per virtual user: publishes, first/last time, iteration duration (s)."""
    return (measures.groupBy("vu").agg(
        F.sum("sent").alias("sent"), F.sum("failed").alias("failed"),
        F.sum(F.when(F.col("sent") == 1, F.col("bytes"))).alias("data_sent"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .withColumn("iteration_s", (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6))


def counters(measures: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """A2: ``metric, total, rate`` with rate = total / elapsed seconds of the run.

    The run lasts from the first to the last sample unless ``elapsed_seconds``
    is given (e.g. the configured test duration).  ``mqtt_calls`` counts
    publish attempts plus one connect per user.
    """
    t = per_vu(measures).agg(
        F.sum("sent").alias("mqtt_messages_sent"), F.sum("failed").alias("mqtt_messages_failed"),
        F.count(F.lit(1)).alias("mqtt_concurrent_connections"),
        F.sum("data_sent").alias("data_sent"),
        F.min("first_ts").alias("t0"), F.max("last_ts").alias("t1"))
    t = (t.withColumn("iterations", F.col("mqtt_concurrent_connections"))
         .withColumn("mqtt_calls", F.col("mqtt_messages_sent") + F.col("mqtt_messages_failed")
                     + F.col("mqtt_concurrent_connections"))
         .withColumn("elapsed", F.lit(float(elapsed_seconds)) if elapsed_seconds is not None
                     else (F.unix_micros("t1") - F.unix_micros("t0")) / 1e6))
    names = ["mqtt_calls", "mqtt_concurrent_connections", "mqtt_messages_sent", "mqtt_messages_failed",
             "iterations", "data_sent"]
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("total")) for n in names])
    return (t.select("elapsed", F.explode(entries).alias("e"))
            .select(F.col("e.metric").alias("metric"), F.col("e.total").alias("total"),
                    F.round(F.col("e.total") / F.col("elapsed"), 6).alias("rate")))


def samples(measures: DataFrame) -> DataFrame:
    """Long form ``metric, x`` of the trend samples."""
    ok = measures.where(F.col("sent") == 1)
    per_message = ok.select(F.explode(F.array(
        F.struct(F.lit("mqtt_message_duration").alias("metric"), F.col("duration_ms").cast("double").alias("x")),
        F.struct(F.lit("mqtt_message_bytes").alias("metric"), F.col("bytes").cast("double").alias("x")),
    )).alias("s")).select("s.*")
    iterations = per_vu(measures).select(F.lit("iteration_duration").alias("metric"),
                                         F.col("iteration_s").alias("x"))
    return per_message.unionByName(iterations)


def trend(measures: DataFrame, method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """Avg, min, med, max, p90, p95, p99 per metric.

    ``method``: ``exact`` (default) interpolated percentiles computed by
    ``quantiles.exact_percentiles`` without gathering a metric in one task;
    ``builtin`` Spark's ``percentile`` (one buffer of distinct values per
    metric); ``approx`` ``percentile_approx`` with ``accuracy``.
    """
    x = F.col("x")
    s = samples(measures)
    r = lambda c: F.round(c.cast("double"), 6)
    if method == "exact":
        # one pass over the samples: every statistic comes from the value counts
        freq = frequencies(s, "metric", "x")
        stats = freq.groupBy("metric").agg(
            F.sum("_c").alias("n"), (F.sum(x * F.col("_c")) / F.sum("_c")).alias("avg"),
            F.min(x).alias("min"), F.max(x).alias("max"))
        q = exact_percentiles(s, "metric", "x", PERCENTILES, freq=freq)
        qs = q.groupBy("metric").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"_q{i}")
                                       for i, p in enumerate(PERCENTILES)])
        g = stats.join(qs, "metric", "left")
        qcol = [F.col(f"_q{i}") for i in range(len(PERCENTILES))]
    else:
        agg = F.percentile_approx(x, PERCENTILES, accuracy) if method == "approx" else F.percentile(x, PERCENTILES)
        g = s.groupBy("metric").agg(F.count(x).alias("n"), F.avg(x).alias("avg"), F.min(x).alias("min"),
                                    F.max(x).alias("max"), agg.alias("q"))
        qcol = [F.col("q")[i] for i in range(len(PERCENTILES))]
    return g.select("metric", "n", r(F.col("avg")).alias("avg"), r(F.col("min")).alias("min"),
                    r(qcol[0]).alias("med"), r(F.col("max")).alias("max"),
                    r(qcol[1]).alias("p90"), r(qcol[2]).alias("p95"), r(qcol[3]).alias("p99"))


def verdict(trend_df: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """A4: one row per threshold: observed statistic and whether it passed."""
    checks = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(rule).alias("rule"),
                                F.col(stat).alias("observed"), F.lit(limit).alias("threshold"))
                       for m, rule, stat, limit in thresholds])
    return (trend_df.select("metric", F.explode(checks).alias("c"))
            .where(F.col("metric") == F.col("c.m"))
            .select("metric", F.col("c.rule").alias("rule"), F.col("c.observed").alias("observed"),
                    F.col("c.threshold").alias("threshold"),
                    (F.col("c.observed") < F.col("c.threshold")).alias("passed")))
