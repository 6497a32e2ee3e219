"""Known values at sf0.01 (FIXTURES.md) and the contains-vs-parsed difference."""

from pyspark.sql import functions as F

from celltide.operators import logs as LG
from celltide.operators import shadow as SH
from celltide.operators import windows as W
from celltide.operators.quantiles import exact_percentiles
from celltide.sources import fixtures as X

from locations import SF_ORACLE


def test_value_percentiles(spark):
    ev = X.load_events(spark, SF_ORACLE).withColumn("all", F.lit("all"))
    got = {r["p"]: round(r["value"], 6) for r in exact_percentiles(ev, "all", "value", [0.5, 0.9, 0.95, 0.99]).collect()}
    assert got == {0.5: 34.59, 0.9: 113.285, 0.95: 147.3535, 0.99: 224.3453}


def test_window_groups(spark):
    ev = X.load_events(spark, SF_ORACLE)
    assert W.tumbling(ev, "ts", "3 seconds", ("event_type",)).count() == 9992


def test_users_seen_in_last_6_hours(spark):
    ev = X.load_events(spark, SF_ORACLE)
    per_user = ev.select(F.col("user_id").cast("string").alias("row_key"), F.col("ts").alias("publish_time"),
                         F.col("event_id").alias("seq"), F.create_map().cast("map<string,variant>").alias("obj"))
    active = SH.active_devices(SH.device_shadow(per_user, []), "6 hours", F.lit(LG.newest(ev, "ts")))
    assert active.where("active").count() == 64


def test_contains_filter_differs_from_parsed_level(spark):
    logs = LG.parse_logs(X.log_lines(X.load_events(spark, SF_ORACLE)))
    raw = logs.where(F.col("line").contains("level=error"))
    parsed = logs.where(F.col("level") == "error")
    extra = raw.where(F.col("level") != "error").count()
    assert extra > 0 and raw.count() == parsed.count() + extra


def test_counters_with_given_duration(spark):
    from celltide.operators import slo as SL
    m = X.delivery_measures(X.load_events(spark, SF_ORACLE))
    got = {r["metric"]: (r["total"], r["rate"]) for r in SL.counters(m, elapsed_seconds=60.0).collect()}
    sent = m.where("sent = 1").count()
    assert got["mqtt_messages_sent"] == (sent, round(sent / 60.0, 6))
    assert got["mqtt_concurrent_connections"][0] == 150
