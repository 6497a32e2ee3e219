"""Queries on the ingest path: catalog, topics, envelopes, typed views, table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from celltide.operators import audit as A
from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.operators import routing as R
from celltide.operators import schema as S
from celltide.operators import table as TB
from celltide.plans import oracles as O
from celltide.plans.registry import query
from celltide.sources import catalog as K
from celltide.sources import fixtures as X
from celltide.storage import list_subdirs, new_location

_TABLES: dict[tuple[str, str], str] = {}


def cells_table(spark: SparkSession, sf_dir: str) -> str:
    """Cells of the sparse messages written once per session to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES or not list_subdirs(spark, _TABLES[key]):  # written once; again if removed
        path = new_location(spark, "cells")
        msgs = X.sparse_messages(X.load_events(spark, sf_dir))
        TB.write_cells(C.to_cells(D.good(D.decode(msgs, K.default_catalog()))), path)
        _TABLES[key] = path
    return _TABLES[key]


@query("catalog", """
WITH f(pos, name, type) AS (VALUES (1, 'id', 'STRING'), (2, 'timestamp', 'TIMESTAMP'), (3, 'value', 'FLOAT'),
                                   (4, 'k', 'INTEGER'), (5, 'relation', 'STRING'))
SELECT r.relation, f.pos, f.name, f.type
FROM (SELECT DISTINCT event_type AS relation FROM events) r, f""")
def q_catalog(spark, sf_dir):
    """S14 + J1: catalog rows of the relations that occur in the message stream."""
    msgs = D.decode(X.messages(X.load_events(spark, sf_dir)), K.default_catalog())
    return K.catalog_in_use(K.default_catalog(), D.good(msgs).select("relation"))


@query("topic_filter", """
SELECT event_id, event_type AS relation, 'telemetry/' || event_type || '/' || CAST(user_id AS VARCHAR) AS topic
FROM events WHERE event_type = 'purchase' OR user_id = 42""")
def q_topic_filter(spark, sf_dir):
    """S3: subscription with ``#`` and ``+`` wildcards."""
    msgs = X.messages(X.load_events(spark, sf_dir))
    sub = R.subscribe(msgs, ["telemetry/purchase/#", "telemetry/+/42"])
    return sub.select(F.col("seq").alias("event_id"), F.col("attributes")["relation"].alias("relation"), "topic")


@query("forward", "SELECT event_id, event_type AS relation, value FROM events")
def q_forward(spark, sf_dir):
    """S4 + P12: payload forwarded unchanged as a record, read back from the record."""
    rec = R.forward_records(X.messages(X.load_events(spark, sf_dir)), "mqtt-source")
    body = F.from_json(F.col("value").cast("string"),
                       "id STRING, timestamp STRING, value DOUBLE, k INT, relation STRING")
    return rec.select(F.col("key").cast("string").cast("long").alias("event_id"),
                      body["relation"].alias("relation"), body["value"].alias("value"))


@query("envelope", O.with_(O.EV) + f"""
SELECT event_id, {O.PAYLOAD} AS payload, event_type AS attr_relation FROM ev""")
def q_envelope(spark, sf_dir):
    """S2 + S5: REST envelopes (10 messages each) decoded back to payload + attributes."""
    bodies = X.envelopes(X.load_events(spark, sf_dir), batch_size=10)
    msgs = D.decode_envelopes(bodies)
    return msgs.select(F.col("attributes")["message_id"].cast("long").alias("event_id"),
                       F.col("payload").cast("string").alias("payload"),
                       F.col("attributes")["relation"].alias("attr_relation"))


@query("bounded_read", "SELECT event_id FROM events ORDER BY event_id LIMIT 100")
def q_bounded_read(spark, sf_dir):
    """S6 + O2: stop after 100 messages, in source order."""
    return A.bounded_read(X.messages(X.load_events(spark, sf_dir)), 100).select(F.col("seq").alias("event_id"))


@query("bounded_runs", "SELECT event_id, CAST(CASE WHEN event_id < 40 THEN 0 WHEN event_id < 90 THEN 1 ELSE 2 END AS INTEGER) AS run FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS i FROM events) WHERE i <= 100")
def q_bounded_runs(spark, sf_dir):
    """Stop after 40, then 50, then 10 messages and go on where the run before stopped; nothing twice."""
    msgs, path = X.messages(X.load_events(spark, sf_dir)), new_location(spark, "runs")
    for n in (40, 50, 10):
        A.read_next(msgs, path, n)
    return A.all_read(spark, path, msgs.schema).select(F.col("seq").alias("event_id"), F.col("run").cast("int").alias("run"))


@query("typed", """
SELECT event_id, event_type || '-' || CAST(user_id AS VARCHAR) AS id, ts,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 89 = 2 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
       event_type AS relation
FROM events""")
def q_typed(spark, sf_dir):
    """Typed view by catalog types; a value that does not convert is NULL."""
    msgs = D.good(D.decode(X.nonconforming_messages(X.load_events(spark, sf_dir)), K.default_catalog()))
    t = S.typed_view(msgs, K.EVENT_FIELDS)
    return t.select(F.col("seq").alias("event_id"), "id", F.col("timestamp").cast("timestamp_ntz").alias("ts"),
                    "value", "k", "relation")


@query("conformance", """
WITH m AS (SELECT event_type AS relation, event_id % 89 AS r FROM events),
f(field) AS (VALUES ('id'), ('timestamp'), ('value'), ('k'), ('relation'))
SELECT relation, field,
       CAST(sum(CASE WHEN field = 'k' AND r = 2 THEN 1 ELSE 0 END) AS BIGINT) AS missing,
       CAST(0 AS BIGINT) AS extra,
       CAST(sum(CASE WHEN field = 'value' AND r = 0 THEN 1 ELSE 0 END) AS BIGINT) AS badly_typed
FROM m, f GROUP BY relation, field
UNION ALL
SELECT relation, 'x', CAST(0 AS BIGINT), CAST(count(*) AS BIGINT), CAST(0 AS BIGINT) FROM m WHERE r = 1 GROUP BY relation""")
def q_conformance(spark, sf_dir):
    """Missing, extra and badly typed fields per relation against the catalog."""
    msgs = D.good(D.decode(X.nonconforming_messages(X.load_events(spark, sf_dir)), K.default_catalog()))
    return S.conformance(msgs, K.default_catalog())


@query("route", """
SELECT event_type AS relation,
       CAST(sum(4 + CAST(event_id % 5 <> 0 AS INT) + CAST(event_id % 7 = 0 OR event_id % 3 <> 0 AS INT)) AS BIGINT)
         AS n_rows,
       CAST(count(DISTINCT user_id) AS BIGINT) AS n_keys
FROM events GROUP BY event_type""")
def q_route(spark, sf_dir):
    """S7/S8 + P9: one write partitioned by relation, counted back per partition."""
    path = cells_table(spark, sf_dir)
    return (TB.read_cells(spark, path).groupBy("relation")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_key").alias("n_keys")))


@query("scan", O.with_(O.EV, O.SPARSE_CELLS) + """
SELECT c.row_key, c.family, c.qualifier, c.value, c.event_id FROM cells c JOIN ev USING (event_id)
WHERE ev.event_type = 'purchase'""")
def q_scan(spark, sf_dir):
    """S9 + O4: full scan of one relation (partition-pruned), in row-key order."""
    df = TB.scan(spark, cells_table(spark, sf_dir), relation="purchase", ordered=True)
    return df.select("row_key", "family", "qualifier", "value", F.col("seq").alias("event_id"))


@query("list_relations", "SELECT DISTINCT event_type AS relation FROM events")
def q_list_relations(spark, sf_dir):
    """Relations present in the cells table."""
    return TB.list_relations(spark, cells_table(spark, sf_dir))


@query("clear_relation", O.with_(O.EV, O.SPARSE_CELLS) + """
SELECT ev.event_type AS relation, CAST(count(*) AS BIGINT) AS n
FROM cells c JOIN ev USING (event_id)
WHERE ev.event_type <> 'error' AND ev.user_id % 10 <> 0
GROUP BY ev.event_type""")
def q_clear_relation(spark, sf_dir):
    """S12 + J4: copy of the table, relation ``error`` cleared, then every row
    key of users with ``user_id % 10 = 0`` deleted; remaining rows per relation."""
    src = TB.read_cells(spark, cells_table(spark, sf_dir))
    path = new_location(spark, "cells-copy")
    TB.write_cells(src, path)
    TB.clear_relation(spark, path, "error")
    ev = X.load_events(spark, sf_dir)
    keys = ev.where(F.col("user_id") % 10 == 0).select(X.device_id().alias("row_key"))
    TB.delete_keys(spark, path, keys)
    return TB.read_cells(spark, path).groupBy("relation").agg(F.count(F.lit(1)).alias("n"))


@query("stream_cells", O.with_(O.EV, O.SPARSE_CELLS) +
       "SELECT row_key, family, qualifier, value, event_id FROM cells")
def q_stream_cells(spark, sf_dir):
    """S1 + T1 + S7 under Structured Streaming: messages landed as 4 files, one
    checkpointed ``availableNow`` run of the foreachBatch ingest (2 files per
    micro-batch), cells read back from the written table.  A large input lands as
    more files, and half of them, at most ``BATCH_FILES``, make a micro-batch."""
    from celltide.streaming import ingest as IG
    from celltide.streaming import sources as SS
    landing = new_location(spark, "landing")
    files = SS.land_messages(X.sparse_messages(X.load_events(spark, sf_dir)), landing, files=4)
    out = new_location(spark, "stream-cells")
    q = IG.start_ingest(SS.landed_messages(spark, landing, SS.files_per_batch(files, 2)), K.default_catalog(), out,
                        new_location(spark, "stream-quarantine"), new_location(spark, "stream-ckpt"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return TB.read_cells(spark, out).select("row_key", "family", "qualifier", "value",
                                                   F.col("seq").alias("event_id"))
