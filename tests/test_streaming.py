"""Streaming = batch, restart safety, windows, dedup and shadow under readStream."""

import pytest
from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import table as TB
from celltide.operators import table_log as TL
from celltide.sources import catalog as K
from celltide.sources import fixtures as X
from celltide.streaming import ingest as IG
from celltide.streaming import sources as SS
from celltide.streaming import stateful as ST

from locations import SF_SMALL


def _land(spark, tmp_dir, files):
    ev = X.load_events(spark, SF_SMALL)
    msgs = X.bad_messages(ev)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(msgs, landing, files=files)
    return msgs, landing


def _run_ingest(spark, tmp_dir, landing, max_files=None):
    out = f"{tmp_dir}/cells"
    quar = f"{tmp_dir}/quarantine"
    ckpt = f"{tmp_dir}/ckpt"
    q = IG.start_ingest(SS.landed_messages(spark, landing, max_files), K.default_catalog(), out, quar, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    return out, quar, ckpt


def _key(df):
    return sorted(tuple(r) for r in df.select("row_key", "family", "qualifier", "value", "seq").collect())


def test_stream_equals_batch_for_1_and_3_files(spark, tmp_dir):
    for files, max_files in [(1, None), (3, 1)]:
        d = f"{tmp_dir}/f{files}"
        msgs, landing = _land(spark, d, files)
        out, quar, _ = _run_ingest(spark, d, landing, max_files)
        batch = C.to_cells(D.good(D.decode(msgs, K.default_catalog())))
        assert _key(TB.read_cells(spark, out)) == _key(batch)
        bad = IG.read_quarantine(spark, quar).groupBy("reason").count().collect()
        expect = D.quarantine_counts(D.decode(msgs, K.default_catalog())).collect()
        assert sorted(map(tuple, bad)) == sorted(map(tuple, expect))


def test_restart_adds_no_rows(spark, tmp_dir):
    msgs, landing = _land(spark, tmp_dir, 2)
    out, quar, ckpt = _run_ingest(spark, tmp_dir, landing)
    n1 = TB.read_cells(spark, out).count()
    # same checkpoint, nothing new: no rows added
    out2, _, _ = _run_ingest(spark, tmp_dir, landing)
    assert TB.read_cells(spark, out2).count() == n1
    n_bad = IG.read_quarantine(spark, quar).count()
    # a replayed batch replaces what it wrote, also under another date and another catalog
    write = f"{IG.query_id(spark, ckpt)}-0"
    one = spark.read.schema(SS.MESSAGE_SCHEMA).parquet(landing).withColumn(IG.INGEST_TIME, F.current_timestamp() - F.expr("INTERVAL 1 DAY"))
    IG.ingest_batch(one, write, K.Catalog({"view": K.EVENT_FIELDS}), out, quar)
    assert [r[0] for r in TB.read_cells(spark, out).select("relation").distinct().collect()] == ["view"]
    IG.ingest_batch(one, write, K.default_catalog(), out, quar)
    assert TB.read_cells(spark, out).count() == n1 and IG.read_quarantine(spark, quar).count() == n_bad
    # another query's batch 0 stays apart
    IG.ingest_batch(one, "other-0", K.default_catalog(), out, quar)
    assert TB.read_cells(spark, out).count() == 2 * n1


def test_tumbling_stream_update_equals_batch(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.messages(ev), landing, files=3)
    stream = D.good(D.decode(SS.landed_messages(spark, landing, 1), K.default_catalog()))
    val = F.try_element_at(F.col("obj"), F.lit("value")).try_cast("double")
    agg = ST.tumbling_stream(stream, value=val)
    q = (agg.writeStream.outputMode("complete").format("memory").queryName("tumble_t")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted((r["window_start"], r["relation"], r["n"]) for r in spark.table("tumble_t").collect())
    from celltide.operators import windows as W
    batch = W.tumbling(D.good(D.decode(X.messages(ev), K.default_catalog())), value=val)
    exp = sorted((r["window_start"], r["relation"], r["n"]) for r in batch.collect())
    assert got == exp


def test_dedup_stream(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.duplicated_messages(ev).drop("copy"), landing, files=2)
    d = ST.dedup_stream(SS.landed_messages(spark, landing, 1), delay="1 hour")
    q = (d.writeStream.format("memory").queryName("dedup_t").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    ids = [r["seq"] for r in spark.table("dedup_t").collect()]
    assert len(ids) == len(set(ids)) == ev.count()


def test_shadow_stream_matches_batch(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.sparse_messages(ev), landing, files=3)
    stream = D.good(D.decode(SS.landed_messages(spark, landing, 1), K.default_catalog()))
    s = ST.shadow_stream(stream, ["value", "k"])
    q = (s.writeStream.outputMode("complete").format("memory").queryName("shadow_t")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    from celltide.operators import shadow as SH
    batch = SH.device_shadow(D.good(D.decode(X.sparse_messages(ev), K.default_catalog())), ["value", "k"])
    cols = ["id", "n_messages", "f_value", "f_k"]
    assert sorted(map(tuple, spark.table("shadow_t").select(cols).collect())) == \
        sorted(map(tuple, batch.select(cols).collect()))


def test_window_rows_stream_matches_batch(spark, tmp_dir):
    from celltide.operators import windows as W
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.messages(ev), landing, files=2)
    stream = D.good(D.decode(SS.landed_messages(spark, landing, 1), K.default_catalog()))
    q = (ST.window_rows_stream(stream).writeStream.outputMode("complete").format("memory")
         .queryName("wrows_t").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("wrows_t").select("relation", "n", "ids").collect())
    batch = W.window_rows(D.good(D.decode(X.messages(ev), K.default_catalog())))
    assert got == sorted(tuple(r) for r in batch.select("relation", "n", "ids").collect())


def test_ingest_with_dedup(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.duplicated_messages(ev).drop("copy"), landing, files=2)
    q = IG.start_ingest(SS.landed_messages(spark, landing), K.default_catalog(), f"{tmp_dir}/c", f"{tmp_dir}/q",
                        f"{tmp_dir}/ck", dedup_delay="1 hour")
    q.awaitTermination(300)
    out = TB.read_cells(spark, f"{tmp_dir}/c")
    once = C.to_cells(D.good(D.decode(X.messages(ev), K.default_catalog())))
    assert out.count() == once.count()


def test_catalog_from_schema_file(spark, tmp_dir):
    p = f"{tmp_dir}/schemas.json"
    with open(p, "w") as f:
        f.write(K.REFERENCE_SCHEMAS_JSON)
    cat = K.Catalog.from_file(spark, p)
    assert cat.relations == K.reference_catalog().relations
    assert cat.fields("machine_metrics")[3] == ("motor_rpm", "INTEGER")
    assert [f.dataType.simpleString() for f in cat.struct_type("weather_sensor").fields] == \
        ["string", "timestamp", "double", "double", "double", "double", "double"]


def test_late_rows_side_output(spark, tmp_dir):
    from pyspark.sql import Window

    from celltide.streaming import late as LT
    ev = X.load_events(spark, SF_SMALL)
    msgs = X.messages(ev).withColumn("arrival", X.arrival_order("seq"))
    landing = f"{tmp_dir}/landing"
    # land in arrival order, one file per micro-batch: the first file has 10
    # messages, then 50 each, so every delayed message lands one file later
    # than messages with later event times
    n = msgs.count()
    ranked = msgs.withColumn("_f", F.floor((F.row_number().over(Window.orderBy("arrival")) + 39) / 50))
    for i in range((n + 39) // 50 + 1):
        SS.land_messages(ranked.where(F.col("_f") == i).drop("_f", "arrival"), f"{landing}/f{i:03d}", files=1)
    stream = spark.readStream.schema(SS.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{landing}/*")
    path, ckpt = f"{tmp_dir}/split", f"{tmp_dir}/ck"
    q = LT.start_late_split(stream, "publish_time", path, ckpt)
    q.awaitTermination(600)
    assert q.exception() is None

    def split():
        return sorted((r["seq"], r["batch_id"], r["late"]) for r in LT.split_rows(spark, path, stream.schema).collect())

    before = split()
    assert len(before) == n  # nothing lost
    # a delayed row (event_id % 50 = 0) is behind the max event time of the
    # earlier micro-batches
    assert {s for s, _, late in before if late} == set(range(0, n, 50))
    assert {r["seq"] for r in LT.split_rows(spark, path, stream.schema, late=True).collect()} == set(range(0, n, 50))
    # folders are joined, but for the newest batch; that one repeated, before and after, adds no row and splits alike
    query, last = IG.query_id(spark, ckpt), max(b for _, b, _ in before)
    rows = LT.split_rows(spark, path, stream.schema).where(F.col("batch_id") == last).drop("batch_id", "late").collect()
    newest = spark.createDataFrame(rows, stream.schema)
    LT.split_batch(newest, last, "publish_time", path, query)
    assert split() == before
    assert LT.join_batches(spark, path, stream.schema, ["batch_id"]) == 2 and len(TL.snapshot(spark, path).folders) <= 4
    LT.split_batch(newest, last, "publish_time", path, query)
    assert split() == before
    with pytest.raises(ValueError):
        LT.split_batch(newest, last - 1, "publish_time", path, query)


def test_folded_updates_keep_the_last_of_each_group(spark, tmp_dir):
    import os
    rows = [(f"d{i % 7}", float(b * 100 + i), b) for b in range(6) for i in range(b, 9)]
    df = spark.createDataFrame(rows, "id string, v double, batch_id long")
    path = f"{tmp_dir}/updates"
    # within a batch each group has one update
    df.dropDuplicates(["id", "batch_id"]).write.partitionBy("batch_id").parquet(path)
    before = sorted(map(tuple, ST.latest_window_updates(spark, path, ["id"]).collect()))
    ST.fold_updates(spark, path, ["id"], 4)
    assert sorted(d for d in os.listdir(path) if d.startswith("batch_id")) == ["batch_id=4", "batch_id=5"]
    assert sorted(map(tuple, ST.latest_window_updates(spark, path, ["id"]).collect())) == before
    assert spark.read.parquet(path).where("batch_id = 4").count() == 7
