"""Streaming ingest: messages -> decode -> cells + quarantine.

One ``foreachBatch`` feeds two outputs from a single decode of each
micro-batch.  ``foreachBatch`` is at-least-once, so each output carries the
identity of its write, the query's own id (kept in its checkpoint) and the
batch id: a replayed batch replaces what it wrote before, whatever it was,
and never touches another query's rows.  Ingest time is the batch's time from
the offset log, which a replay reads again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import table as TB
from celltide.operators import table_log as TL
from celltide.sources.catalog import Catalog

INGEST_TIME = "ingest_time"
QUARANTINE_DDL = ("seq BIGINT, message_id STRING, topic STRING, publish_time TIMESTAMP, attributes MAP<STRING, STRING>, payload BINARY, "
                  "reason STRING, write STRING, ingest_date DATE")


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave to the query of a checkpoint, the same after each restart."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _for_outputs(decoded: DataFrame) -> DataFrame:
    """What the two outputs read of decoded messages: the source's columns, payload and all, of bad ones alone (else NULL),
    so that a task which takes a message from the cache does not read its bytes beside the object made of them."""
    both = ("seq", INGEST_TIME, "obj", "row_key", "relation", "reason")
    return decoded.select(*both, *(F.when(F.col("reason").isNotNull(), F.col(c)).alias(c) for c in decoded.columns if c not in both))


def ingest_batch(batch: DataFrame, write: str, catalog: Catalog, cells_path: str,
                 quarantine_path: str, include_key: bool = True, meta_family: bool = True) -> None:
    """Decode one micro-batch once, then write good cells and quarantined messages.

    ``batch`` has the messages and their ``ingest_time``; ``write`` names this
    write: a repeated one replaces the earlier attempt in both outputs.
    """
    decoded = _for_outputs(D.decode(batch, catalog)).persist()
    try:
        # ingest time: one value per micro-batch, ties broken by seq
        cells = C.to_cells(D.good(decoded), cell_ts=F.col(INGEST_TIME),
                           include_key=include_key, meta_family=meta_family)
        TB.write_cells(cells, cells_path, write)
        bad = D.quarantined(decoded, (INGEST_TIME,)).withColumn("ingest_date", F.to_date(INGEST_TIME)).drop(INGEST_TIME)
        TL.append(bad.hint("rebalance", "ingest_date"), quarantine_path, ["ingest_date"], write)
    finally:
        decoded.unpersist()


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Quarantined messages as of the last commit."""
    return TL.read(spark, path, QUARANTINE_DDL)


def start_ingest(messages: DataFrame, catalog: Catalog, cells_path: str, quarantine_path: str,
                 checkpoint: str, trigger: dict | None = None, query_name: str | None = None,
                 dedup_delay: str | None = None, **cell_opts) -> StreamingQuery:
    """Start the ingest query; ``trigger`` e.g. ``{"availableNow": True}`` or
    ``{"processingTime": "10 seconds"}``.  With ``dedup_delay`` a message id
    redelivered within that event-time delay is dropped before decoding (T8);
    by default every delivery is kept, as a new cell version."""
    if dedup_delay:
        messages = messages.withWatermark("publish_time", dedup_delay) \
            .dropDuplicatesWithinWatermark(["message_id"])

    def run(batch: DataFrame, batch_id: int) -> None:
        write = f"{query_id(batch.sparkSession, checkpoint)}-{batch_id}"
        ingest_batch(batch, write, catalog, cells_path, quarantine_path, **cell_opts)

    # in a stream this is the batch's time, kept in the offset log
    timed = messages.withColumn(INGEST_TIME, F.current_timestamp())
    w = timed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def forward_stream(records: DataFrame, path: str | None, checkpoint: str, trigger: dict | None = None,
                   kafka_bootstrap: str | None = None) -> StreamingQuery:
    """Forward records (``key, value, topic, headers``) to the next hop.

    Files: exactly once through the checkpointed file sink.  Kafka (when
    ``kafka_bootstrap`` is given; each record's ``topic`` column names the
    target): at least once, with the same checkpoint for restarts.
    """
    w = records.writeStream.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    if kafka_bootstrap:
        return (w.format("kafka").option("kafka.bootstrap.servers", kafka_bootstrap)
                .option("includeHeaders", "true").start())
    return w.format("parquet").start(path)
