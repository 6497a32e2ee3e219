"""Mergeable sketches (A3) within their bound, and bounded reads that go on."""

import math
import random

import pytest
from pyspark.sql import functions as F

from celltide.operators import audit as A
from celltide.operators import sketches as SK
from celltide.operators import table_log as TL
from celltide.streaming import stateful as ST


def samples(spark, seed, n=4000):
    r = random.Random(seed)
    rows = [(i * 7, r.choice(["a", "b"]), r.choice([r.lognormvariate(3, 2), -r.expovariate(0.01), 0.0, 1e-300, 1e300, 42.0])) for i in range(n)]
    rows += [(5, "a", None), (6, "a", math.nan), (7, "a", math.inf)]
    return rows, spark.createDataFrame(rows, "t long, metric string, x double").withColumn("ts", F.timestamp_seconds("t"))


@pytest.mark.parametrize("error", [0.01, 0.001, 0.2])
def test_quantiles_are_within_the_error_after_merging(spark, error):
    rows, df = samples(spark, 1)
    parts = SK.interval_sketches(df, "10 minutes", error)
    ps = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = SK.sketch_quantiles(SK.merged(parts, ("metric",)), ("metric",), ps, error).collect()
    assert len(got) == 2 * len(ps)
    for r in got:
        own = sorted(x for _, m, x in rows if m == r["metric"] and x is not None and math.isfinite(x))
        exact = own[math.floor(r["p"] * (len(own) - 1))]
        assert r["n"] == len(own) and abs(r["value"] - exact) <= error * abs(exact) * (1 + 1e-9)
    # merging is exact: the sketch of all is the sum of the intervals' sketches
    whole = SK.merged(SK.interval_sketches(df, "1000 days", error), ("metric",))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, SK.merged(parts, ("metric",)).collect()))
    with pytest.raises(ValueError):
        SK.cell_of(F.col("x"), 1.0)


def test_hot_metric_has_few_cells_and_is_combined_before_the_shuffle(spark):
    df = spark.range(50_000).select(F.lit("m").alias("metric"), (F.col("id") % 1000 + 0.5).alias("x"), F.timestamp_seconds(F.lit(0)).alias("ts"))
    sketch = SK.interval_sketches(df, "1 hour")
    assert "partial_count" in sketch._jdf.queryExecution().executedPlan().toString() and sketch.count() < 400


def test_stream_in_update_mode_equals_batch_and_forgets(spark, tmp_dir):
    _, df = samples(spark, 2)
    df.repartitionByRange(5, "ts").sortWithinPartitions("ts").write.parquet(f"{tmp_dir}/in")
    import os
    for i, name in enumerate(sorted(x for x in os.listdir(f"{tmp_dir}/in") if x.startswith("part-"))):
        os.utime(f"{tmp_dir}/in/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    held = []
    for _ in range(2):  # the second run starts from the checkpoint and adds nothing
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", "1").parquet(f"{tmp_dir}/in")
        q = ST.start_window_updates(SK.interval_sketches_stream(stream, "10 minutes"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
        q.awaitTermination(300)
        held += [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    got = ST.latest_window_updates(spark, f"{tmp_dir}/out", ["bucket", "metric", "cell"])
    batch = SK.interval_sketches(df, "10 minutes")
    assert sorted(map(tuple, got.select(batch.columns).collect())) == sorted(map(tuple, batch.collect()))
    assert max(held) < batch.count() / 2


def messages(spark, n):
    return spark.range(n).select(F.col("id").alias("seq"), F.timestamp_micros((F.col("id") % 7) * 1_000_001 + 1).alias("at"), F.concat(F.lit("m"), F.col("id")).alias("body"))


@pytest.mark.parametrize("order", [("seq",), ("at", "seq")])
def test_three_runs_are_one_long_one(spark, tmp_dir, order):
    df, path = messages(spark, 100), f"{tmp_dir}/runs"
    runs = [A.read_next(df, path, n, order).collect() for n in (30, 45, 10)]
    want = df.orderBy(*order).limit(85).collect()
    assert [len(r) for r in runs] == [30, 45, 10] and sorted(map(tuple, sum(runs, []))) == sorted(map(tuple, want))
    assert {r["seq"] for r in runs[0]} == {r["seq"] for r in want[:30]}
    assert len(A.read_next(df, path, 1000, order).collect()) == 15 and A.read_next(df, path, 5, order).count() == 0
    # messages that came later
    assert {r["seq"] for r in A.read_next(messages(spark, 107).withColumn("at", F.when(F.col("seq") < 100, F.col("at")).otherwise(F.timestamp_seconds(F.lit(99)))), path, 5, order).collect()} == set(range(100, 105))
    everything = A.all_read(spark, path, df.schema)
    assert everything.count() == 105 and everything.select("seq").distinct().count() == 105 and everything.agg(F.max("run")).first()[0] == 4


def test_a_run_that_breaks_off_has_read_nothing(spark, tmp_dir, monkeypatch):
    df, path = messages(spark, 50), f"{tmp_dir}/runs"
    A.read_next(df, path, 10)
    real = TL.commit
    monkeypatch.setattr(TL, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        A.read_next(df, path, 10)
    monkeypatch.setattr(TL, "commit", real)
    assert {r["seq"] for r in A.read_next(df, path, 10).collect()} == set(range(10, 20))
    assert sorted(r["seq"] for r in A.all_read(spark, path, df.schema).collect()) == list(range(20))
