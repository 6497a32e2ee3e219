"""Table DDL, log files with path labels, forward sink, producer JSON."""

import os

from pyspark.sql import functions as F

from celltide.functions.text import id_relation, iso_text, millis_between, prefixed_id
from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import logs as LG
from celltide.operators import routing as R
from celltide.operators import table as TB
from celltide.sources import catalog as K
from celltide.sources import fixtures as X
from celltide.streaming import ingest as IG
from celltide.streaming import sources as SS
from celltide.streaming import stateful as ST

from locations import SF_SMALL


def test_create_table_and_partitions(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    path = f"{tmp_dir}/cells"
    TB.write_cells(C.to_cells(D.good(D.decode(X.messages(ev), K.default_catalog()))), path)
    TB.create_table(spark, "cells_t", path)
    names = [t.name for t in spark.catalog.listTables()]
    assert "cells_t" in names
    assert spark.table("cells_t").where("relation = 'view'").count() == \
        TB.scan(spark, path, "view").count()
    spark.sql("DROP TABLE cells_t")


def test_read_log_files_labels_from_path(spark, tmp_dir):
    d = f"{tmp_dir}/var/log/pods/verne_listener-1_uid7/listener"
    os.makedirs(d)
    with open(f"{d}/0.log", "w") as f:
        f.write('level=info ts=2024-01-01T00:00:00.000001Z caller=main.go:1 msg="a"\n')
        f.write('level=error ts=2024-01-01T00:00:01Z caller=main.go:2 msg="b \\"level=x\\""\n')
    df = LG.parse_logs(LG.read_log_files(spark, f"{tmp_dir}/var/log/pods/*/*/*.log"))
    rows = df.orderBy("ts").collect()
    assert [(r["namespace"], r["pod"], r["container"]) for r in rows] == [("verne", "listener-1", "listener")] * 2
    assert [r["level"] for r in rows] == ["info", "error"] and rows[1]["msg"] == 'b "level=x"'


def test_forward_stream_exactly_once(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    landing = f"{tmp_dir}/landing"
    SS.land_messages(X.messages(ev), landing, files=2)
    recs = R.forward_records(SS.landed_messages(spark, landing), "mqtt-source")
    for _ in range(2):  # second run from the same checkpoint writes nothing new
        q = IG.forward_stream(recs, f"{tmp_dir}/out", f"{tmp_dir}/ck")
        q.awaitTermination(300)
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == ev.count()
    orig = {r["seq"]: bytes(r["payload"]) for r in X.messages(ev).collect()}
    assert all(orig[int(bytes(r["key"]).decode())] == bytes(r["value"]) for r in out.collect())


def test_relation_json_and_text_helpers(spark):
    df = spark.createDataFrame([("a", 1.5)], "id string, v double")
    js = df.select(R.with_relation_json(df, ["id", "v"], F.lit("dev")).alias("j")).first()["j"]
    assert js == '{"id":"a","v":1.5,"relation":"dev"}'
    r = spark.range(1).select(
        prefixed_id(F.lit("weather_sensor"), F.lit("ab12")).alias("p"),
        id_relation(F.lit("weather_sensor-ab12")).alias("r"),
        iso_text(F.lit("2024-01-01 00:00:01.5").cast("timestamp")).alias("t"),
        millis_between(F.lit("2024-01-01 00:00:00").cast("timestamp"),
                       F.lit("2024-01-01 00:00:01.25").cast("timestamp")).alias("ms")).first()
    assert (r["p"], r["r"], r["t"], r["ms"]) == ("weather_sensor-ab12", "weather_sensor",
                                                  "2024-01-01T00:00:01.500000Z", 1250)


def test_watermark_drops_late_rows_in_stream(spark, tmp_dir):
    # run 1 moves the watermark to t=100 s; run 2 (same checkpoint) brings a row
    # at t=10 s (behind the watermark: dropped) and one at t=200 s
    landing = f"{tmp_dir}/landing"
    base = spark.createDataFrame([(1, 100, "r"), (2, 10, "r"), (3, 200, "r")], "seq long, t long, relation string") \
        .withColumn("publish_time", F.timestamp_seconds("t"))
    schema = "seq long, t long, relation string, publish_time timestamp"

    def run(sub, rows):
        base.where(rows).coalesce(1).write.parquet(f"{landing}/{sub}")
        stream = spark.readStream.schema(schema).parquet(f"{landing}/*")
        agg = ST.tumbling_stream(stream, size="3 seconds", delay="0 seconds")
        q = (agg.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_dir}/out")
             .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None

    run("a", "seq = 1")
    run("b", "seq > 1")
    got = sorted(r["window_start"].timestamp() for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    # the window of t=100 closes when t=200 moves the watermark; t=10 is dropped;
    # the window of t=200 is still open
    assert got == [99.0]


def test_cli_ingest_list_query_clear(spark, tmp_dir, capsys):
    from celltide import cli
    ev = X.load_events(spark, SF_SMALL)
    SS.land_messages(X.sparse_messages(ev), f"{tmp_dir}/landing", files=2)
    base = ["--table", f"{tmp_dir}/t"]
    cli.main(["ingest", "--landing", f"{tmp_dir}/landing", "--quarantine", f"{tmp_dir}/q",
              "--checkpoint", f"{tmp_dir}/ck"] + base)
    cli.main(["list"] + base)
    assert capsys.readouterr().out.split() == ["click", "error", "purchase", "signup", "view"]
    cli.main(["query", "--relation", "view", "--limit", "3"] + base)
    lines = capsys.readouterr().out.strip().split("\n")
    assert len(lines) == 3 and all('"cf2": {"relation": "view"}' in line for line in lines)
    cli.main(["clear", "--relation", "view"] + base)
    cli.main(["list"] + base)
    assert "view" not in capsys.readouterr().out.split()


def test_stream_log_files_and_age_filter(spark, tmp_dir):
    d = f"{tmp_dir}/pods/observe_vernemq-2_uid9/vernemq"
    os.makedirs(d)
    with open(f"{d}/0.log", "w") as f:
        f.write('level=info ts=2024-01-01T00:00:00Z caller=main.go:1 msg="old"\n')
        f.write('level=info ts=2999-01-01T00:00:00Z caller=main.go:2 msg="new"\n')
    logs = LG.parse_logs(LG.stream_log_files(spark, f"{tmp_dir}/pods/*/*/*.log"))
    flagged = LG.reject_old(logs, "ts", F.current_timestamp(), "168 hours")
    q = (flagged.select("namespace", "container", "msg", "rejected").writeStream.format("memory")
         .queryName("logs_t").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted((r["namespace"], r["container"], r["msg"], r["rejected"]) for r in spark.table("logs_t").collect())
    assert got == [("observe", "vernemq", "new", False), ("observe", "vernemq", "old", True)]


def test_cli_panel(spark, tmp_dir, capsys):
    from celltide import cli
    for ns, ctr in (("verne", "listener"), ("observe", "listener")):
        d = f"{tmp_dir}/pods/{ns}_p_u/{ctr}"
        os.makedirs(d)
        with open(f"{d}/0.log", "w") as f:
            f.write('level=info ts=2024-01-01T00:00:00Z caller=a.go:1 msg="old"\n')
            f.write('level=info ts=2024-01-01T10:00:00Z caller=a.go:2 msg="quotes \\"level=error\\""\n')
            f.write('level=error ts=2024-01-01T11:00:00Z caller=a.go:3 msg="boom"\n')
    cli.main(["panel", "--logs", f"{tmp_dir}/pods/*/*/*.log", "--selector", "namespace=verne",
              "--contains", "level=error", "--now", "2024-01-01T12:00:00"])
    lines = capsys.readouterr().out.strip().split("\n")
    assert len(lines) == 2 and "boom" in lines[0] and "quotes" in lines[1]


def test_table_ops_on_stream_layout(spark, tmp_dir):
    ev = X.load_events(spark, SF_SMALL)
    SS.land_messages(X.sparse_messages(ev), f"{tmp_dir}/landing", files=2)
    q = IG.start_ingest(SS.landed_messages(spark, f"{tmp_dir}/landing", 1), K.default_catalog(), f"{tmp_dir}/t",
                        f"{tmp_dir}/q", f"{tmp_dir}/ck")
    q.awaitTermination(300)
    path = f"{tmp_dir}/t"
    before = TB.read_cells(spark, path)
    n, n_view = before.count(), before.where("relation = 'view'").count()
    keys = ev.where("user_id % 10 = 0").select(X.device_id().alias("row_key"))
    n_keys = before.join(keys, "row_key", "left_semi").count()
    n_view_keys = before.where("relation = 'view'").join(keys, "row_key", "left_semi").count()
    TB.delete_keys(spark, path, keys)
    assert TB.read_cells(spark, path).count() == n - n_keys
    TB.clear_relation(spark, path, "view")
    left = TB.read_cells(spark, path)
    assert left.where("relation = 'view'").count() == 0 and "view" not in [r[0] for r in TB.list_relations(spark, path).collect()]
    assert left.count() == n - n_keys - (n_view - n_view_keys)


def test_no_shared_folder_is_a_clear_error(spark, tmp_dir):
    import subprocess
    import sys
    code = ("from celltide.session import get_session; from celltide.storage import new_location\n"
            "spark = get_session('local[1]')\nnew_location(spark, 'x')")
    env = os.environ | {"SPARK_CONF_DIR": tmp_dir, "PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=240)
    assert out.returncode and "spark.checkpoint.dir is not set" in out.stderr
    out = subprocess.run([sys.executable, "-c", code.replace("'local[1]'", f"'local[1]', checkpoint_dir='{tmp_dir}'")], env=env, capture_output=True, text=True, timeout=240)
    assert out.returncode == 0, out.stderr[-500:]


def test_kafka_records(spark):
    rows = [("t", 0, 5, b"k", b"a", [("r", b"1"), ("s", b"2"), ("r", b"3")]), ("t", 1, 5, None, b"b", None), ("t", 0, 6, b"k", b"c", [])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, key binary, value binary, headers array<struct<key:string,value:binary>>") \
        .withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
    got = {r["message_id"]: (bytes(r["payload"]), r["attributes"]) for r in SS.from_kafka(df).collect()}
    assert got == {"t-0-5": (b"a", {"r": "3", "s": "2"}), "t-1-5": (b"b", {}), "t-0-6": (b"c", {})}
    from celltide.operators import windows as W
    assert W.dedup(SS.from_kafka(df)).count() == 3
