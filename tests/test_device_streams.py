"""Device sessions and the delivery audit as streams (A10, T7, J5): equal to batch, restarts, expiry of state."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from celltide.operators import shadow as SH
from celltide.streaming import delivery as DL
from celltide.streaming import devices as DV

ROWS = "row_key string, seq long, t double, obj map<string,string>"
T0 = dt.datetime(2024, 1, 1)


def decoded(spark, rows):
    """Rows (device, seq, seconds, fields) in the form of decoded messages."""
    return spark.createDataFrame(rows, ROWS).withColumn("publish_time", F.timestamp_seconds(1704067200 + F.col("t"))).drop("t")


def traffic(seed, n=400, hot=120):
    r = random.Random(seed)
    rows = [(f"d{r.randrange(25)}", i, r.randrange(40_000) + r.randrange(4) / 4, {k: str(i) for k in ("a", "b") if r.random() < 0.5}) for i in range(n)]
    return rows + [("hot", n + i, 100.0 * i, {"a": str(i)}) for i in range(hot)] + [("pair", 9000, 0.0, {}), ("pair", 9001, 600.0, {}), ("pair", 9002, 1200.25, {})]


def plain_sessions(rows, period):
    out = []
    for d in sorted({r[0] for r in rows}):
        own = sorted((r for r in rows if r[0] == d), key=lambda r: (r[2], r[1]))
        groups = []
        for r in own:
            if groups and r[2] - groups[-1][-1][2] <= period:
                groups[-1].append(r)
            else:
                groups.append([r])
        for g in groups:
            newest = {k: v for r in g for k, v in r[3].items()}
            out.append((d, g[0][2], g[-1][2], g[-1][2] + period, len(g), newest.get("a"), newest.get("b")))
    return sorted(out)


def rows_of(df):
    at = lambda t: (t - T0).total_seconds()
    return sorted(((r["id"], at(r["online_from"]), at(r["last_seen"]), at(r["offline_at"]), r["n_messages"], r["f_a"] and r["f_a"]["value"], r["f_b"] and r["f_b"]["value"]) for r in df.collect()))


def land(spark, rows, path, n):
    os.makedirs(path, exist_ok=True)
    decoded(spark, rows).coalesce(1).write.parquet(f"{path}/f{n}")
    for name in os.listdir(f"{path}/f{n}"):
        if name.startswith("part-"):
            os.utime(f"{path}/f{n}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))


def run(spark, tmp_dir, start):
    schema = decoded(spark, [("x", 1, 0.0, {})]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in/*")
    q = start(stream).option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/out")
    q.awaitTermination(300)
    assert q.exception() is None
    return [p["stateOperators"] for p in q.recentProgress if p["stateOperators"]]


def test_batch_sessions(spark):
    rows = traffic(1)
    got = DV.device_sessions(decoded(spark, rows), "10 MINUTES", ("a", "b"))
    assert rows_of(got) == plain_sessions(rows, 600)
    now = F.lit(T0 + dt.timedelta(seconds=20_000)).cast("timestamp")
    active = {r["id"] for r in DV.active_at(got, now).where("active").collect()}
    assert active == {s[0] for s in plain_sessions(rows, 600) if s[1] <= 20_000 <= s[3]}
    # what the shadow of all messages says, from the sessions
    merged = DV.merged_shadows(got, ("a", "b")).collect()
    shadow = SH.device_shadow(decoded(spark, rows), ["a", "b"]).collect()
    key = lambda r: (r["id"], r["last_seen"], r["n_messages"], r["f_a"], r["f_b"])
    assert sorted(map(key, merged), key=str) == sorted(map(key, shadow), key=str)
    off = sorted((r["id"], r["offline_from"], r["offline_until"]) for r in DV.offline_intervals(got).where("id = 'hot' OR id = 'pair'").collect())
    assert [x[0] for x in off] == ["hot", "pair", "pair"] and off[1][2] == T0 + dt.timedelta(seconds=1200.25) and off[2][2] is None


def test_stream_sessions_equal_batch_over_restarts_and_expire(spark, tmp_dir):
    rows = sorted(traffic(2), key=lambda r: r[2])
    start = lambda s: DV.device_sessions_stream(s, "10 MINUTES", fields=("a", "b")).writeStream.format("parquet")
    thirds = [[r for r in rows if 14_000 * i <= r[2] < 14_000 * (i + 1)] for i in range(3)]
    for i, part in enumerate(thirds[:2]):
        land(spark, part, f"{tmp_dir}/in", i)
    states = run(spark, tmp_dir, start)
    first = spark.read.parquet(f"{tmp_dir}/out").count()
    land(spark, thirds[2], f"{tmp_dir}/in", 2)
    land(spark, [("sentinel", 10_000, 90_000.0, {})], f"{tmp_dir}/in", 3)
    states += run(spark, tmp_dir, start)  # restarted from its checkpoint
    run(spark, tmp_dir, start)  # nothing new: adds nothing
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert 0 < first < got.count() and rows_of(got.where("id <> 'sentinel'")) == plain_sessions(rows, 600)
    held = [s[0]["numRowsTotal"] for s in states]
    devices = len({r[0] for r in rows})
    assert held[-1] <= 1 < max(held) and max(held) <= len(plain_sessions(rows, 600)) and devices > 1


def test_unpublished_messages_are_reported_once(spark, tmp_dir):
    """Missing, late, in time, received again, published twice, published without receipt."""
    steps = [("ok", "received", 0), ("ok", "published", 50), ("edge", "received", 0), ("edge", "published", 60), ("late", "received", 10), ("late", "published", 71),
             ("missing", "received", 20), ("missing", "queued", 21), ("again", "received", 30), ("again", "received", 45), ("twice", "received", 31), ("twice", "published", 40),
             ("twice", "published", 41), ("late-again", "received", 5), ("late-again", "published", 70), ("late-again", "published", 75), ("stray", "published", 33),
             ("failed", "received", 200), ("failed", "failed", 201), ("done", "received", 210), ("done", "published", 215), ("end", "other", 5000)]
    steps = spark.createDataFrame(steps, "msg_hash string, step string, t long").withColumn("ts", F.timestamp_seconds(1704067200 + F.col("t"))).drop("t")
    bounds = (0, 40, 100, 4000, 9000)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        part = steps.where((F.unix_timestamp("ts") - 1704067200 >= a) & (F.unix_timestamp("ts") - 1704067200 < b))
        part.coalesce(1).write.parquet(f"{tmp_dir}/in/f{i}")
        for name in os.listdir(f"{tmp_dir}/in/f{i}"):
            os.utime(f"{tmp_dir}/in/f{i}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    for _ in range(2):  # the second run adds nothing
        stream = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in/*")
        q = DL.unpublished_stream(stream, "1 MINUTE").writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/out")
        q.awaitTermination(300)
        assert q.exception() is None
    got = spark.read.parquet(f"{tmp_dir}/out")
    want = {"late": 10, "missing": 20, "again": 30, "late-again": 5, "failed": 200}
    found = sorted((r["msg_hash"], int((r["received_ts"] - T0).total_seconds()), int((r["due"] - r["received_ts"]).total_seconds())) for r in got.collect())
    assert found == sorted((k, t, 60) for k, t in want.items())
    assert sorted(r["msg_hash"] for r in DL.unpublished(steps, "1 MINUTE").collect()) == sorted(want)
