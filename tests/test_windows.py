"""Windows, lateness and dedup against brute force."""

import random

from pyspark.sql import functions as F

from celltide.operators import windows as W


def test_late_flags_match_brute_force(spark):
    rng = random.Random(7)
    n = 3000
    rows = [(i, rng.randint(0, 10_000)) for i in range(n)]
    order = list(range(n))
    rng.shuffle(order)
    data = [(order[i], rows[i][1]) for i in range(n)]
    df = spark.createDataFrame(data, "arrival long, t long").withColumn("ts", F.timestamp_seconds("t"))
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = dict(W.late_flags(df, "arrival", "ts", 0.0).select("arrival", "is_late").collect())
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        seen = -1
        expect = {}
        for a, t in sorted(data):
            expect[a] = t < seen
            seen = max(seen, t)
        assert got == expect, parts


def test_late_flags_delay(spark):
    df = spark.createDataFrame([(0, 100), (1, 95), (2, 89)], "arrival long, t long") \
        .withColumn("ts", F.timestamp_seconds("t"))
    got = dict(W.late_flags(df, "arrival", "ts", 10.0).select("arrival", "is_late").collect())
    assert got == {0: False, 1: False, 2: True}


def test_window_rows_one_row_per_group(spark):
    df = spark.createDataFrame([(i, "r") for i in range(2500)], "seq long, relation string") \
        .withColumn("publish_time", F.timestamp_seconds(F.lit(0)))
    (row,) = W.window_rows(df).collect()
    assert row["n"] == 2500 and [int(x) for x in row["ids"].split(",")] == list(range(2500))


def test_tumbling_epoch_aligned(spark):
    df = spark.createDataFrame([(0, 1.0), (2, 2.0), (3, 4.0), (5, 8.0), (6, 16.0)], "t long, v double") \
        .withColumn("publish_time", F.timestamp_seconds("t")).withColumn("relation", F.lit("r"))
    out = {r["window_start"].second: (r["n"], r["sum_value"])
           for r in W.tumbling(df, value=F.col("v")).collect()}
    assert out == {0: (2, 3.0), 3: (2, 12.0), 6: (1, 16.0)}


def test_dedup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "message_id string, seq long")
    assert W.dedup(df).count() == 2


def test_exact_percentiles_match_numpy(spark):
    import numpy as np

    from celltide.operators.quantiles import exact_percentiles
    rng = random.Random(3)
    data = [("a", float(rng.randint(0, 50))) for _ in range(1000)] + \
           [("b", rng.random() * 100) for _ in range(777)] + [("c", 5.0)] + [("d", None)]
    df = spark.createDataFrame(data, "k string, x double")
    ps = [0.0, 0.5, 0.9, 0.95, 0.99, 1.0]
    for blocks in (1, 4, 64):
        got = {(r["k"], r["p"]): r["value"]
               for r in exact_percentiles(df, "k", "x", ps, blocks=blocks).collect()}
        for k in ("a", "b", "c"):
            xs = np.array([v for kk, v in data if kk == k and v is not None])
            for p in ps:
                assert abs(got[(k, p)] - float(np.quantile(xs, p))) < 1e-9, (k, p, blocks)
        assert not any(k == "d" for k, _ in got)


def test_window_chunks_of_one_group_of_all_rows(spark):
    """One group holds nearly all rows, with ties and a null key beside it: chunks are full, in order, and cut over several parts."""
    df = spark.range(20_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 100 == 7, F.lit(None)).otherwise("r").alias("relation"), (F.col("id") * 2).alias("v"),
                                    F.timestamp_seconds(F.lit(0)).alias("publish_time"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = W.window_chunks(df, values=("v",), rows=300).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for key in ("r", None):
        own = sorted((r for r in got if r["relation"] == key), key=lambda r: r["chunk"])
        ids = [i for i in range(20_000) if (i % 100 == 7) == (key is None)]
        assert [r["chunk"] for r in own] == list(range(-(-len(ids) // 300))) and {r["n"] for r in own} == {len(ids)}
        assert [(x["seq"], x["v"]) for r in own for x in r["items"]] == [(i, 2 * i) for i in ids]
        assert all(len(r["items"]) == 300 for r in own[:-1])


def test_window_chunks_split_a_hot_group_over_parts(spark):
    df = spark.range(5_000).select(F.col("id").alias("seq"), F.lit("r").alias("relation"), F.timestamp_seconds(F.lit(0)).alias("publish_time"))
    plan = W.window_chunks(df, rows=100)
    sizes = [len(r["items"]) for r in plan.collect()]
    assert sizes == [100] * 50 and W.window_chunks(df.limit(0)).count() == 0
