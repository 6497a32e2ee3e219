"""The write log of a table: replays, snapshots of readers, compaction, conflicts, vacuum."""

import os

import pytest
from pyspark.sql import functions as F

from celltide import storage
from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import table as TB
from celltide.operators import table_log as TL
from celltide.sources import catalog as K
from celltide.sources import fixtures as X

from locations import SF_SMALL


@pytest.fixture(scope="module")
def cells(spark):
    events = X.load_events(spark, SF_SMALL)
    return C.to_cells(D.good(D.decode(X.messages(events), K.default_catalog()))).persist()


def some_cells(spark, n=6, days=1, relation="r", start=0):
    rows = [(f"k{i}", "cf1", "q", str(i), i, relation, i % days) for i in range(start, start + n)]
    df = spark.createDataFrame(rows, "row_key string, family string, qualifier string, value string, seq long, relation string, d int")
    ts = F.timestamp_seconds(F.col("d") * 86400)
    return df.withColumn("cell_ts", ts).withColumn("event_ts", ts).withColumn("ingest_date", F.to_date(ts)).drop("d")


def keys_of(df):
    return sorted(r[0] for r in df.select("row_key").collect())


def test_a_repeated_write_replaces_itself_and_broken_ones_are_unseen(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    TB.write_cells(some_cells(spark, 4), path, "q-0")
    TB.write_cells(some_cells(spark, 2, relation="s"), path, "q-1")
    TB.write_cells(some_cells(spark, 3, relation="other", start=10), path, "q-0")  # another relation: the old one goes
    assert keys_of(TB.read_cells(spark, path)) == ["k0", "k1", "k10", "k11", "k12"]
    assert [r[0] for r in TB.list_relations(spark, path).orderBy("relation").collect()] == ["other", "s"]
    # files of a write that never committed are in no read, and its repetition starts clean
    some_cells(spark, 50, start=100).write.partitionBy("relation", "ingest_date").parquet(f"{path}/write=q-2")
    assert TB.read_cells(spark, path).count() == 5
    TB.write_cells(some_cells(spark, 1, start=200), path, "q-2")
    assert TB.read_cells(spark, path).count() == 6
    TB.write_cells(some_cells(spark, 0), path, "q-2")  # repeated with nothing
    assert TB.read_cells(spark, path).count() == 5
    with pytest.raises(ValueError):
        TB.write_cells(some_cells(spark, 1), path, "a/b")


def test_listing_does_not_grow_with_days_or_commits(spark, tmp_dir, monkeypatch):
    """A micro-batch lists the log and its own folder, whatever the table holds."""
    path, listed = f"{tmp_dir}/t", []
    for name in ("list_names", "leaf_folders"):
        real = getattr(storage, name)
        monkeypatch.setattr(TL, name, lambda s, p, real=real, name=name: listed.append((name, p, len(real(s, p)))) or real(s, p))
    for name in ("glob_paths", "list_subdirs"):
        monkeypatch.setattr(storage, name, lambda *a: pytest.fail("lists the table"))

    def listings(batch):
        del listed[:]
        TB.write_cells(some_cells(spark, 2, start=2 * batch), path, f"q-{batch}")
        return [(n, p.startswith(f"{path}/write=q-{batch}") or p.endswith("_log")) for n, p, _ in listed], max(x for *_, x in listed)

    first = listings(0)
    TB.write_cells(some_cells(spark, 400, days=40, relation="old"), path)
    for batch in range(1, 4):
        later = listings(batch)
    assert first[0] == later[0] and all(own for _, own in later[0])
    # hundreds of commits: the log is folded, and a listing of it stays short
    for i in range(3 * TL.FOLD):
        TL.commit(spark, path, lambda s, i=i: ({f"write=x{i}/relation=none/ingest_date=1970-01-01": f"x{i}"}, [f"write=x{i - 1}/relation=none/ingest_date=1970-01-01"] if i else []))
    assert listings(9)[1] <= 4 * TL.FOLD  # with checksum files of the local file system
    state = TL.snapshot(spark, path)
    assert state.version >= 3 * TL.FOLD and state.of_write("x1") == [] and len(state.of_write(f"x{3 * TL.FOLD - 1}")) == 1


def test_a_reader_sees_each_row_once_while_days_are_joined(spark, tmp_dir, cells, monkeypatch):
    path = f"{tmp_dir}/t"
    for part in range(3):
        TB.write_cells(cells.where(F.col("seq") % 3 == part), path)
    key = lambda df: sorted(map(str, df.select(*TB.CELL_COLUMNS).collect()))
    early = TB.read_cells(spark, path)  # planned before, run after
    before, seen = key(early), []
    real = TL.commit
    monkeypatch.setattr(TL, "commit", lambda *a, **k: seen.append(key(TB.read_cells(spark, path))) or real(*a, **k))
    assert TB.compact(spark, path, "2024-01-20") > 0
    monkeypatch.undo()
    assert seen == [before] and key(early) == before and key(TB.read_cells(spark, path)) == before
    folders = [TL.partition(f) for f in TL.snapshot(spark, path).folders]
    joined = [(p["relation"], p["ingest_date"]) for p in folders if p["ingest_date"] < "2024-01-20"]
    assert len(joined) == len(set(joined)) and any(p["ingest_date"] >= "2024-01-20" for p in folders)
    assert TB.compact(spark, path, "2024-01-20") == 0  # nothing left to join
    # what left the table is kept for readers, then deleted
    gone = sorted(TL.snapshot(spark, path).removed)
    assert gone and TB.vacuum(spark, path) == 0 and os.path.isdir(f"{path}/{gone[0]}")
    assert TB.vacuum(spark, path, keep_hours=0) == len(gone) and not os.path.exists(f"{path}/{gone[0]}")
    assert key(TB.read_cells(spark, path)) == before and not TL.snapshot(spark, path).removed


def test_compaction_leaves_the_batch_that_may_be_repeated(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for batch in range(3):
        TB.write_cells(some_cells(spark, 2, start=2 * batch), path, f"q-{batch}")
    assert TB.compact(spark, path, "2000-01-01") == 1
    TB.write_cells(some_cells(spark, 2, start=4), path, "q-2")  # repeated after its day was joined
    assert keys_of(TB.read_cells(spark, path)) == [f"k{i}" for i in range(6)]
    assert TB.compact(spark, path, "2000-01-01", ended=True) == 1
    assert len(TL.snapshot(spark, path).folders) == 1 and TB.read_cells(spark, path).count() == 6


def test_conflicting_commits(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    for i in range(2):
        TB.write_cells(some_cells(spark, 2, start=2 * i), path)
    # two commits for one number: the second is asked again
    state, asked = TL.snapshot(spark, path), []

    def change(now):
        asked.append(now.version)
        if len(asked) == 1:
            TL.commit(spark, path, lambda s: ({"write=first/relation=none/ingest_date=1970-01-01": "first"}, []))
        return {"write=second/relation=none/ingest_date=1970-01-01": "second"}, []

    after = TL.commit(spark, path, change)
    assert asked == [state.version, state.version + 1] and after.of_write("first") and after.of_write("second")
    TL.commit(spark, path, lambda s: ({}, [*s.of_write("first"), *s.of_write("second")]))
    # a relation cleared while its days are joined stays cleared
    real = TL.leaf_folders
    monkeypatch.setattr(TL, "leaf_folders", lambda s, p: TB.clear_relation(s, path, "r") and real(s, p))
    assert TB.compact(spark, path, "2000-01-01") == 0 and TB.read_cells(spark, path).count() == 0


def test_keyed_deletes_keep_the_write_of_each_row(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    TB.write_cells(some_cells(spark, 4), path, "q-0")
    TB.write_cells(some_cells(spark, 4, start=4), path, "q-1")
    TB.write_cells(some_cells(spark, 2, start=20, relation="a/b {x}"), path)
    early = TB.read_cells(spark, path)
    TB.delete_keys(spark, path, spark.createDataFrame([("k1",), ("k5",), ("k21",), ("none",)], "row_key string"))
    assert keys_of(TB.read_cells(spark, path)) == ["k0", "k2", "k20", "k3", "k4", "k6", "k7"] and early.count() == 10
    TB.write_cells(some_cells(spark, 2, start=4), path, "q-1")  # the batch repeated replaces its remaining rows
    assert keys_of(TB.read_cells(spark, path)) == ["k0", "k2", "k20", "k3", "k4", "k5"]
    TB.delete_keys(spark, path, TB.read_cells(spark, path).select("row_key"))
    assert TB.read_cells(spark, path).count() == 0 and TB.list_relations(spark, path).count() == 0
    assert TB.vacuum(spark, path, keep_hours=0) > 0 and [d for d in os.listdir(path) if not d.startswith((".", "_"))] == []


def test_catalog_table_follows_the_commits(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    TB.write_cells(some_cells(spark, 4, days=2, relation="it's a/b"), path)
    TB.write_cells(some_cells(spark, 4, days=2, start=4), path)
    TB.create_table(spark, "log_t", path)
    assert spark.table("log_t").count() == 8
    TB.compact(spark, path, "2000-01-01")
    TB.clear_relation(spark, path, "it's a/b")
    TB.register_partitions(spark, "log_t")
    spark.catalog.refreshTable("log_t")
    assert keys_of(spark.table("log_t")) == keys_of(TB.read_cells(spark, path)) == ["k4", "k5", "k6", "k7"]
    spark.sql("DROP TABLE log_t")


def test_storage_files_are_whole_and_not_replaced(spark, tmp_dir):
    assert storage.read_file(spark, f"{tmp_dir}/x") is None and storage.list_names(spark, f"{tmp_dir}/none") == {}
    assert storage.write_new(spark, f"{tmp_dir}/x", "é") and not storage.write_new(spark, f"{tmp_dir}/x", "other")
    assert storage.read_file(spark, f"{tmp_dir}/x") == "é" and storage.leaf_folders(spark, f"{tmp_dir}/none") == []
