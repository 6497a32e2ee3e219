"""Landed messages in files of bounded size, whatever the input: no task reads a fixed share of it."""

import datetime as dt

from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import table as TB
from celltide.plans import q_ingest as QI
from celltide.plans import q_jobs as QJ
from celltide.plans import q_reports as QR
from celltide.sources import catalog as K
from celltide.sources import fixtures as X
from celltide.storage import list_names
from celltide.streaming import ingest as IG
from celltide.streaming import sources as SS

from locations import SF_SMALL

COLUMNS = ["row_key", "family", "qualifier", "value", "seq"]


def landings(monkeypatch):
    """Make landed files small; the list gets the folder and the returned number of each landing."""
    seen, land = [], SS.land_messages
    monkeypatch.setattr(SS, "FILE_ROWS", 100)
    monkeypatch.setattr(SS, "BATCH_FILES", 2)
    monkeypatch.setattr(SS, "land_messages", lambda m, path, *a, **k: seen.append((path, n := land(m, path, *a, **k))) or n)
    return seen


def rows_by_file(spark, path):
    return [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]


def batch_cells(spark):
    msgs = X.sparse_messages(X.load_events(spark, SF_SMALL))
    return sorted(map(repr, C.to_cells(D.good(D.decode(msgs, K.default_catalog()))).select(*COLUMNS).collect()))


def test_landed_files_follow_the_input_and_are_read_in_order(spark, tmp_dir):
    msgs, path = X.messages(X.load_events(spark, SF_SMALL)), f"{tmp_dir}/landing"
    n = msgs.count()
    assert SS.land_messages(msgs, path, files=2, rows_per_file=100) == -(-n // 100)
    assert max(rows_by_file(spark, path)) <= 110 and sum(rows_by_file(spark, path)) == n
    first = SS.landed_files(spark, path)
    assert SS.land_messages(msgs, path, files=3) == 3 and SS.landed_files(spark, path)[:len(first)] == first
    times = list_names(spark, path)
    ordered = [times[f.rpartition("/")[2]] for f in SS.landed_files(spark, path)]
    assert len(set(ordered)) == len(first) + 3 and ordered == sorted(ordered)
    assert (SS.files_per_batch(4, 2), SS.files_per_batch(1, 2), SS.files_per_batch(1000, 2)) == (2, 1, SS.BATCH_FILES)


def test_two_runs_of_many_batches_are_replayed_batch_by_batch(spark, monkeypatch):
    seen = landings(monkeypatch)
    table = QJ._two_runs(spark, SF_SMALL)
    assert all(n >= 5 and max(rows_by_file(spark, path)) <= 110 for path, n in seen)
    cells = TB.read_cells(spark, table).cache()
    assert sorted(map(repr, cells.select(*COLUMNS).collect())) == batch_cells(spark)
    days = {half: {r[0] for r in cells.where(F.col("seq") % 2 == half).select("ingest_date").distinct().collect()} for half in (0, 1)}
    assert max(days[1]) < min(days[0]) and min(days[0]) - max(days[1]) <= dt.timedelta(days=2)  # every batch of the second was replaced
    cells.unpersist()


def test_stream_cells_and_shadow_read_files_of_bounded_size(spark, monkeypatch):
    seen = landings(monkeypatch)
    got = QI.q_stream_cells(spark, SF_SMALL).withColumnRenamed("event_id", "seq").select(*COLUMNS).collect()
    assert sorted(map(repr, got)) == batch_cells(spark)
    shadows = QR.q_stream_shadow(spark, SF_SMALL)
    assert shadows.agg(F.sum("n_messages")).first()[0] == X.load_events(spark, SF_SMALL).count()
    assert len(seen) == 2 and all(n >= 10 and max(rows_by_file(spark, path)) <= 110 for path, n in seen)


def test_a_cached_batch_holds_no_payload_beside_its_object(spark, tmp_dir, monkeypatch):
    held = lambda: {r.id(): r.memSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    msgs = X.bad_messages(X.load_events(spark, SF_SMALL)).withColumn(IG.INGEST_TIME, F.current_timestamp())
    before, sizes, write = held(), [], TB.write_cells
    whole = D.decode(msgs, K.default_catalog()).persist()
    bad = sorted(map(repr, D.quarantined(whole).collect()))
    full = sum(n for i, n in held().items() if i not in before)
    whole.unpersist(blocking=True)
    before = held()
    monkeypatch.setattr(TB, "write_cells", lambda *a, **k: (write(*a, **k), sizes.append(sum(n for i, n in held().items() if i not in before))))
    IG.ingest_batch(msgs, "job-0", K.default_catalog(), f"{tmp_dir}/cells", f"{tmp_dir}/bad")
    assert 0 < sizes[0] < 0.8 * full
    quarantine = IG.read_quarantine(spark, f"{tmp_dir}/bad").drop("write", "ingest_date")
    assert sorted(map(repr, quarantine.collect())) == bad and bad
