"""Command line for the cells store and the ingest job.

    python -m celltide.cli ingest --landing DIR --table DIR --quarantine DIR --checkpoint DIR
    python -m celltide.cli init --table DIR [--name cells]
    python -m celltide.cli list --table DIR
    python -m celltide.cli query --table DIR --relation R [--limit N]
    python -m celltide.cli clear --table DIR --relation R
    python -m celltide.cli compact --table DIR --before 2024-01-31
    python -m celltide.cli vacuum --table DIR [--keep-hours 24]
    python -m celltide.cli panel --logs GLOB [--selector namespace=verne] [--contains level=error]

``query`` prints the newest value of every cell of the relation's rows as
``{row_key: {family: {qualifier: value}}}`` lines; the work (latest per cell,
row maps) runs on the cluster and only the printed rows reach the driver.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import table as TB
from celltide.session import get_session
from celltide.sources.catalog import Catalog, default_catalog


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="celltide")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--landing", required=True)
    ing.add_argument("--table", required=True)
    ing.add_argument("--quarantine", required=True)
    ing.add_argument("--checkpoint", required=True, help="where the job keeps its progress; the same one after a restart")
    ing.add_argument("--catalog", help="schema file (JSON: relation -> [{name, type}])")
    ing.add_argument("--trigger-seconds", type=int, default=0, help="0: process what is there and stop")
    ing.add_argument("--max-files-per-trigger", type=int)
    pan = sub.add_parser("panel", help="log lines: label selector, raw-line contains, time range, newest first")
    pan.add_argument("--logs", required=True, help="log files (glob), e.g. /var/log/pods/*/*/*.log")
    pan.add_argument("--selector", action="append", default=[], help="label=value, repeatable")
    pan.add_argument("--contains")
    pan.add_argument("--hours", type=float, default=6)
    pan.add_argument("--now", type=dt.datetime.fromisoformat, help="end of the time range (default: the clock, UTC)")
    pan.add_argument("--limit", type=int)
    for name in ("init", "list", "query", "clear", "compact", "vacuum"):
        p = sub.add_parser(name)
        p.add_argument("--table", required=True)
        if name in ("query", "clear"):
            p.add_argument("--relation", required=True)
        if name == "query":
            p.add_argument("--limit", type=int)
        if name == "compact":
            p.add_argument("--before", required=True, help="join the writes of days before this one (ISO date)")
        if name == "vacuum":
            p.add_argument("--keep-hours", type=float, default=24.0, help="keep what left the table within this time, for reads that go on")
        if name == "init":
            p.add_argument("--name", default="cells")
    a = ap.parse_args(argv)
    spark = get_session(app_name=f"celltide-{a.cmd}")

    if a.cmd == "ingest":
        from celltide.streaming import ingest as IG
        from celltide.streaming import sources as SS
        cat = Catalog.from_file(spark, a.catalog) if a.catalog else default_catalog()
        trigger = {"processingTime": f"{a.trigger_seconds} seconds"} if a.trigger_seconds else {"availableNow": True}
        q = IG.start_ingest(SS.landed_messages(spark, a.landing, a.max_files_per_trigger), cat, a.table,
                            a.quarantine, a.checkpoint, trigger)
        q.awaitTermination()
    elif a.cmd == "init":
        TB.create_table(spark, a.name, a.table)
    elif a.cmd == "list":
        for r in TB.list_relations(spark, a.table).orderBy("relation").toLocalIterator():
            print(r["relation"])
    elif a.cmd == "query":
        rows = C.row_maps(C.latest_cells(TB.scan(spark, a.table, a.relation)))
        rows = rows.orderBy("row_key")
        rows = rows if a.limit is None else rows.limit(a.limit)
        for r in rows.select("row_key", F.to_json("cells")).toLocalIterator():
            print(json.dumps({r[0]: json.loads(r[1])}))
    elif a.cmd == "panel":
        from celltide.operators import logs as LG
        logs = LG.parse_logs(LG.read_log_files(spark, a.logs)).withColumn("seq", F.monotonically_increasing_id())
        selector = dict(kv.split("=", 1) for kv in a.selector)
        now = a.now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = LG.panel(logs, selector, a.contains, now=now, since=dt.timedelta(hours=a.hours), limit=a.limit, time_col="ts")
        for r in rows.select("line").toLocalIterator():
            print(r["line"])
    elif a.cmd == "compact":
        print(TB.compact(spark, a.table, a.before))
    elif a.cmd == "vacuum":
        print(TB.vacuum(spark, a.table, a.keep_hours))
    elif a.cmd == "clear":
        TB.clear_relation(spark, a.table, a.relation)


if __name__ == "__main__":
    main()
