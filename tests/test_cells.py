"""Sparse merge, versions, row maps and the cells table."""

from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import table as TB
from celltide.sources.catalog import Catalog

CAT = Catalog({"dev": [("id", "STRING")]})


def _cells(spark, payloads, ts=None):
    rows = [(i, str(i), p.encode(), (ts or [0] * len(payloads))[i]) for i, p in enumerate(payloads)]
    df = (spark.createDataFrame(rows, "seq long, message_id string, payload binary, t long")
          .withColumn("publish_time", F.timestamp_seconds("t")))
    return C.to_cells(D.good(D.decode(df, CAT)))


def test_sparse_merge_per_cell(spark):
    cells = _cells(spark, ['{"id":"k","relation":"dev","a":1,"b":2}', '{"id":"k","relation":"dev","a":3,"c":4}'],
                   ts=[1, 2])
    m = C.row_maps(C.latest_cells(cells)).first()["cells"]["cf1"]
    assert {k: m[k] for k in ("a", "b", "c")} == {"a": "3", "b": "2", "c": "4"}


def test_ties_broken_by_seq_and_present_null_wins(spark):
    cells = _cells(spark, ['{"id":"k","relation":"dev","a":1}', '{"id":"k","relation":"dev","a":null}'])
    latest = {r["qualifier"]: r["value"] for r in C.latest_cells(cells).collect()}
    assert "a" in latest and latest["a"] is None


def test_latest_idempotent_under_redelivery(spark):
    p = ['{"id":"k","relation":"dev","a":1}', '{"id":"k","relation":"dev","a":2}']
    once = sorted(C.latest_cells(_cells(spark, p, [1, 2])).drop("cell_ts").collect())
    twice = sorted(C.latest_cells(_cells(spark, p + p, [1, 2, 1, 2])).drop("cell_ts").collect())
    assert once == twice


def test_cell_versions(spark):
    p = [f'{{"id":"k","relation":"dev","a":{i}}}' for i in range(5)]
    v = C.cell_versions(_cells(spark, p, list(range(5))), n=2).where("qualifier = 'a'").orderBy("version").collect()
    assert [(r["version"], r["value"], r["n_versions"]) for r in v] == [(1, "4", 5), (2, "3", 5)]


def test_key_skipped_variant(spark):
    cells = C.to_cells(D.good(D.decode(
        spark.createDataFrame([(0, "0", b'{"id":"k","relation":"dev","a":1}')],
                              "seq long, message_id string, payload binary")
        .withColumn("publish_time", F.current_timestamp()), CAT)), include_key=False, meta_family=False)
    assert sorted(r["qualifier"] for r in cells.collect()) == ["a", "relation"]


def test_table_write_scan_clear_delete(spark, tmp_dir):
    p = [f'{{"id":"d{i % 4}","relation":"{"dev" if i % 2 else "dev2"}","a":{i}}}' for i in range(40)]
    cat = Catalog({"dev": [("id", "STRING")], "dev2": [("id", "STRING")]})
    df = (spark.createDataFrame([(i, str(i), s.encode(), i * 3600) for i, s in enumerate(p)],
                                "seq long, message_id string, payload binary, t long")
          .withColumn("publish_time", F.timestamp_seconds("t")))
    cells = C.to_cells(D.good(D.decode(df, cat)))
    path = f"{tmp_dir}/cells"
    TB.write_cells(cells, path)
    n_all = cells.count()
    assert TB.read_cells(spark, path).count() == n_all
    assert sorted(r[0] for r in TB.list_relations(spark, path).collect()) == ["dev", "dev2"]
    scan = TB.scan(spark, path, "dev", ordered=True)
    assert "PartitionFilters: [isnotnull(relation" in scan._jdf.queryExecution().executedPlan().toString() \
        or "relation" in str(scan._jdf.queryExecution().executedPlan().toString())
    keys = [r["row_key"] for r in scan.select("row_key").collect()]
    assert keys == sorted(keys)
    TB.clear_relation(spark, path, "dev2")
    assert sorted(r[0] for r in TB.list_relations(spark, path).collect()) == ["dev"]
    TB.delete_keys(spark, path, spark.createDataFrame([("d1",)], "row_key string"))
    left = TB.read_cells(spark, path)
    assert left.where("row_key = 'd1'").count() == 0
    assert left.count() == cells.where("relation = 'dev' AND row_key <> 'd1'").count()


def test_event_time_parsed_next_to_ingest_time(spark):
    cells = _cells(spark, ['{"id":"k","relation":"dev","timestamp":"2024-01-01T00:00:07.179575Z"}',
                           '{"id":"k","relation":"dev","timestamp":"bad"}', '{"id":"k","relation":"dev"}'])
    ev = {r["seq"]: r["event_ts"] for r in cells.select("seq", "event_ts").distinct().collect()}
    assert ev[0].microsecond == 179575 and ev[1] is None and ev[2] is None


def test_scan_reads_only_the_relation_folder(spark, tmp_dir):
    cat = Catalog({"a/b": [("id", "STRING")], "plain": [("id", "STRING")]})
    df = (spark.createDataFrame([(0, "0", b'{"id":"k","relation":"a/b","v":1}'),
                                 (1, "1", b'{"id":"j","relation":"plain","v":2}')],
                                "seq long, message_id string, payload binary")
          .withColumn("publish_time", F.timestamp_seconds(F.lit(0))))
    path = f"{tmp_dir}/cells"
    TB.write_cells(C.to_cells(D.good(D.decode(df, cat))), path)
    got = TB.scan(spark, path, "a/b")
    assert {r["row_key"] for r in got.collect()} == {"k"}
    assert sorted(TB.scan(spark, path, "plain").select("relation").distinct().collect()) == [("plain",)]
    assert TB.scan(spark, path, "missing").count() == 0
    assert sorted(r[0] for r in TB.list_relations(spark, path).collect()) == ["a/b", "plain"]


def test_clear_and_delete_with_escaped_relation(spark, tmp_dir):
    cat = Catalog({"a/b": [("id", "STRING")], "plain": [("id", "STRING")]})
    df = (spark.createDataFrame([(0, "0", b'{"id":"k","relation":"a/b"}'), (1, "1", b'{"id":"j","relation":"plain"}'),
                                 (2, "2", b'{"id":"i","relation":"a/b"}')],
                                "seq long, message_id string, payload binary")
          .withColumn("publish_time", F.timestamp_seconds(F.lit(0))))
    path = f"{tmp_dir}/cells"
    TB.write_cells(C.to_cells(D.good(D.decode(df, cat))), path)
    TB.delete_keys(spark, path, spark.createDataFrame([("k",), ("i",)], "row_key string"))
    assert sorted(r[0] for r in TB.list_relations(spark, path).collect()) == ["plain"]
    TB.clear_relation(spark, path, "plain")
    assert TB.list_relations(spark, path).count() == 0


def test_expire_partitions(spark, tmp_dir):
    p = [f'{{"id":"k{i % 3}","relation":"dev","a":{i}}}' for i in range(10)]
    cells = _cells(spark, p, ts=[i * 86400 for i in range(10)])  # one message per day from 1970-01-01
    path = f"{tmp_dir}/cells"
    TB.write_cells(cells, path)
    removed = TB.expire_partitions(spark, path, keep_days=3, today="1970-01-10")
    assert len(removed) == 6  # days 1..6 are older than 1970-01-07
    left = TB.read_cells(spark, path)
    assert sorted({str(r[0]) for r in left.select("ingest_date").collect()}) == \
        ["1970-01-07", "1970-01-08", "1970-01-09", "1970-01-10"]
    assert TB.expire_partitions(spark, path, keep_days=0, today="1971-01-01") and \
        TB.list_relations(spark, path).count() == 0
