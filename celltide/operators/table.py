"""The cells table on Parquet.

Layout, for batch and streaming writers alike:
``<path>/write=<w>/relation=<r>/ingest_date=<d>/part-*.parquet``, with a write
log (``table_log``) that says which of these folders make up the table.  A
relation is a partition, so choosing a relation or a date range reads only its
folders, and ``row_key`` is sorted inside each file so that row-group
statistics skip data on key lookups.  Every change (a write, a repeated write,
clearing, keyed deletes, expiry, compaction) is one commit: readers see it
whole or not at all.  ``vacuum`` deletes what is no longer part of the table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.operators import table_log as TL
from celltide.operators.table_log import vacuum  # noqa: F401  (part of the table's operations)
from celltide.storage import delete_path, leaf_folders, list_subdirs, rename_path

PARTITION_COLS = ["write", "relation", "ingest_date"]
CELL_COLUMNS = ["row_key", "family", "qualifier", "value", "cell_ts", "event_ts", "seq", "relation",
                "ingest_date"]

CELLS_DDL = ("row_key STRING, family STRING, qualifier STRING, value STRING, cell_ts TIMESTAMP, "
             "event_ts TIMESTAMP, seq BIGINT, write STRING, relation STRING, ingest_date DATE")


def write_cells(cells: DataFrame, path: str, write: str | None = None) -> None:
    """One write routed by relation (``partitionBy``), never a loop per relation.

    The ``rebalance`` hint clusters rows by (relation, date) and lets adaptive
    execution size the tasks: small partitions are coalesced (few files per
    folder) and a hot relation or day is split over several tasks, so file
    size follows ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.  With
    ``write`` what an earlier attempt of that write committed is replaced.
    """
    rows = cells.select(*CELL_COLUMNS).hint("rebalance", "relation", "ingest_date") \
        .sortWithinPartitions("relation", "ingest_date", "row_key")
    TL.append(rows, path, ["relation", "ingest_date"], write)


def create_table(spark: SparkSession, name: str, path: str) -> None:
    """Catalog table over the folder, partitioned as the files are."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({CELLS_DDL}) USING parquet "
              f"PARTITIONED BY ({', '.join(PARTITION_COLS)}) LOCATION '{path}'")
    register_partitions(spark, name)


def register_partitions(spark: SparkSession, name: str) -> None:
    """Make the catalog table's partitions those of the newest commit: add the new ones, drop those that left."""
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    wanted = set(TL.snapshot(spark, location).folders)
    have = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").toLocalIterator()}

    def spec(folder: str) -> str:
        quoted = {k: v.replace("\\", "\\\\").replace("'", "\\'") for k, v in TL.partition(folder).items()}
        return "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in quoted.items()) + ")"

    for verb, some, between in (("ADD IF NOT EXISTS", wanted - have, " "), ("DROP IF EXISTS", have - wanted, ", ")):
        some = sorted(some)
        for i in range(0, len(some), 500):
            spark.sql(f"ALTER TABLE {name} {verb} {between.join(map(spec, some[i:i + 500]))}")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last commit."""
    return TL.read(spark, path, CELLS_DDL)


def scan(spark: SparkSession, path: str, relation: str | None = None,
         ordered: bool = False) -> DataFrame:
    """Rows of one relation, in row-key order on request.

    Only the relation's folders are listed and read; the partition filter
    stays in the plan as well.
    """
    if relation is None:
        df = read_cells(spark, path)
    else:
        df = TL.read(spark, path, CELLS_DDL, lambda p: p["relation"] == relation).where(F.col("relation") == relation)
    return df.orderBy("row_key", "family", "qualifier", "seq") if ordered else df


def list_relations(spark: SparkSession, path: str) -> DataFrame:
    """Relations present in the table, from its log (no folder is listed and no file opened)."""
    names = sorted({TL.partition(f)["relation"] for f in TL.snapshot(spark, path).folders})
    return spark.createDataFrame([(n,) for n in names], "relation string")


def clear_relation(spark: SparkSession, path: str, relation: str) -> bool:
    """Drop every row of a relation, in one commit."""
    found = False

    def change(now: TL.Snapshot) -> tuple[dict[str, str], list[str]]:
        nonlocal found
        gone = [f for f in now.folders if TL.partition(f)["relation"] == relation]
        found = bool(gone)
        return {}, gone

    TL.commit(spark, path, change)
    return found


def compact(spark: SparkSession, path: str, before: str, ended: bool = False) -> int:
    """Join the folders of each (relation, day) before ``before`` (ISO date) into one; returns how many were joined.

    A streaming job leaves a folder for each relation, day and micro-batch; run
    this on days it has left behind (``table_log.join_writes``: one job, one
    commit, and the batch that may still be repeated is left out).
    """
    return TL.join_writes(spark, path, CELLS_DDL, ["relation", "ingest_date"], ["row_key"], lambda p: p["ingest_date"] < before, ended)


def expire_partitions(spark: SparkSession, path: str, keep_days: int, today: str) -> list[str]:
    """P25 on the store: remove the days older than ``today - keep_days``
    (ISO dates) of every relation, in one commit; returns the removed
    (relation, day) names."""
    cutoff = (dt.date.fromisoformat(today) - dt.timedelta(days=keep_days)).isoformat()
    gone: list[str] = []

    def change(now: TL.Snapshot) -> tuple[dict[str, str], list[str]]:
        gone[:] = [f for f in now.folders if TL.partition(f)["ingest_date"] < cutoff]
        return {}, gone

    TL.commit(spark, path, change)
    return sorted({f.split("/", 1)[1] for f in gone})


def delete_keys(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "row_key") -> None:
    """Remove all cells of the given row keys, in one commit.

    Folders that hold a deleted key are found first; the rows they keep
    (``left_anti`` on the keys) are written anew and take their place.  Rows
    stay with the write that they came from, so a repeated batch still
    replaces them.  A commit in between that takes one of the folders away
    makes it start again.
    """
    root = path.rstrip("/")
    keys = keys.select(F.col(key_col).alias("row_key")).distinct()
    while True:
        now = TL.snapshot(spark, path)
        folder_of = {tuple(TL.partition(f)[c] for c in PARTITION_COLS): f for f in now.folders}
        at = TL.read(spark, path, CELLS_DDL, folders=now.folders).join(keys, "row_key", "left_semi").select(*(F.col(c).cast("string") for c in PARTITION_COLS))
        touched = sorted(folder_of[tuple(r)] for r in at.distinct().toLocalIterator())  # at most a row for each folder
        if not touched:
            return
        tag, staged = uuid.uuid4().hex[:12], f"{root}/_staged-{uuid.uuid4().hex}"
        kept = TL.read(spark, path, CELLS_DDL, folders=touched).join(keys, "row_key", "left_anti").withColumn("write", F.concat("write", F.lit(f"~{tag}")))
        kept.select(*CELL_COLUMNS, "write").hint("rebalance", *PARTITION_COLS).sortWithinPartitions(*PARTITION_COLS, "row_key") \
            .write.partitionBy(*PARTITION_COLS).parquet(staged)
        owner = {TL.partition(f)["write"]: now.folders[f] for f in touched}
        add = {leaf: owner[TL.partition(leaf)["write"].removesuffix(f"~{tag}")] for leaf in leaf_folders(spark, staged)}
        for folder in list_subdirs(spark, staged):
            if folder.startswith("write="):
                rename_path(spark, f"{staged}/{folder}", f"{root}/{folder}")
        delete_path(spark, staged)
        after = TL.commit(spark, path, lambda s: (add, touched) if s.folders.keys() >= set(touched) else ({}, ()))
        if not after.folders.keys() & set(touched) and after.folders.keys() >= add.keys():
            return
