"""Registered queries: each reads the driver's tables under ``sf_dir``.

``events`` table.  The oracle SQL next to each query restates the expected
result for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.operators import cells as C
from celltide.operators import decode as D
from celltide.plans import oracles as O
from celltide.plans.registry import query
from celltide.sources import catalog as K
from celltide.sources import fixtures as X


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.load_events(spark, sf_dir)


def sparse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse messages -> decode -> good -> cells (version time = publish time)."""
    msgs = X.sparse_messages(_events(spark, sf_dir))
    return C.to_cells(D.good(D.decode(msgs, K.default_catalog())))


# ------------------------------------------------------------- cells

@query("cells", O.with_(O.EV, O.SPARSE_CELLS) +
       "SELECT row_key, family, qualifier, value, event_id FROM cells")
def q_cells(spark, sf_dir):
    """P3-P7, T1 (batch form): one row per cell version."""
    return sparse_cells(spark, sf_dir).select(
        "row_key", "family", "qualifier", "value", F.col("seq").alias("event_id"))


@query("cells_no_key", O.with_(O.EV, O.SPARSE_CELLS) +
       "SELECT row_key, family, qualifier, value, event_id FROM cells "
       "WHERE family = 'cf1' AND qualifier <> 'id'")
def q_cells_no_key(spark, sf_dir):
    """Payload cells without the key column, cf1 only."""
    msgs = X.sparse_messages(_events(spark, sf_dir))
    cells = C.to_cells(D.good(D.decode(msgs, K.default_catalog())), include_key=False, meta_family=False)
    return cells.select("row_key", "family", "qualifier", "value", F.col("seq").alias("event_id"))


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells table as written by the ingest path (read side of the store)."""
    from celltide.operators import table as TB
    from celltide.plans.q_ingest import cells_table
    return TB.read_cells(spark, cells_table(spark, sf_dir))


@query("latest_cell", O.with_(O.EV, O.SPARSE_CELLS, O.LATEST) +
       "SELECT row_key, family, qualifier, value FROM latest")
def q_latest_cell(spark, sf_dir):
    """A5: newest value per (row, family, qualifier) read from the cells table;
    present-null wins when newest."""
    return C.latest_cells(stored_cells(spark, sf_dir)).select("row_key", "family", "qualifier", "value")


@query("row_map", O.with_(O.EV, O.SPARSE_CELLS, O.LATEST) + """
SELECT row_key,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'id') AS f_id,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'timestamp') AS f_timestamp,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'value') AS f_value,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'k') AS f_k,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'relation') AS f_relation,
  max(value) FILTER (WHERE family = 'cf2' AND qualifier = 'relation') AS cf2_relation
FROM latest GROUP BY row_key""")
def q_row_map(spark, sf_dir):
    """Nested map {family: {qualifier: newest value}} per row, read back as columns."""
    m = C.row_maps(C.latest_cells(stored_cells(spark, sf_dir)))
    cf1 = F.col("cells").getItem("cf1")
    return m.select(
        "row_key",
        *[cf1.getItem(q).alias(f"f_{q}") for q in ("id", "timestamp", "value", "k", "relation")],
        F.col("cells").getItem("cf2").getItem("relation").alias("cf2_relation"))


@query("typed_latest", O.with_(O.EV, O.SPARSE_CELLS, O.LATEST) + """
SELECT row_key,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'id') AS id,
  strptime(max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'timestamp'), '%Y-%m-%dT%H:%M:%S.%fZ')
    AS "timestamp",
  TRY_CAST(max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'value') AS DOUBLE) AS value,
  TRY_CAST(max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'k') AS INTEGER) AS k,
  max(value) FILTER (WHERE family = 'cf1' AND qualifier = 'relation') AS relation
FROM latest GROUP BY row_key""")
def q_typed_latest(spark, sf_dir):
    """P11 on the cells table: newest values per row, pivoted by the catalog and typed."""
    from celltide.operators import schema as S
    t = S.typed_latest(C.latest_cells(stored_cells(spark, sf_dir)), K.EVENT_FIELDS)
    return t.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("cell_versions", O.with_(O.EV, O.SPARSE_CELLS) + """
SELECT row_key, family, qualifier, version, value, n_versions FROM (
  SELECT row_key, family, qualifier, value,
         CAST(row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, event_id DESC) AS INTEGER)
           AS version,
         count(*) OVER (PARTITION BY row_key, family, qualifier) AS n_versions
  FROM cells) WHERE version <= 3""")
def q_cell_versions(spark, sf_dir):
    """A6 + W1: newest 3 versions of each cell and the version count (cells table)."""
    return C.cell_versions(stored_cells(spark, sf_dir), n=3)


# -------------------------------------------------------- quarantine

@query("quarantine", """
SELECT CASE event_id % 97 WHEN 0 THEN 'BAD_JSON' WHEN 1 THEN 'NOT_OBJECT' WHEN 2 THEN 'NO_ID'
         WHEN 3 THEN 'ID_NOT_STRING' WHEN 4 THEN 'NO_RELATION' WHEN 5 THEN 'UNKNOWN_RELATION'
         ELSE 'BAD_UTF8' END AS reason,
       count(*) AS n
FROM events WHERE event_id % 97 < 7 GROUP BY 1""")
def q_quarantine(spark, sf_dir):
    """Count of set-aside messages per reason."""
    msgs = X.bad_messages(_events(spark, sf_dir))
    return D.quarantine_counts(D.decode(msgs, K.default_catalog()))


@query("quarantine_rows", """
SELECT event_id,
       CASE event_id % 97 WHEN 0 THEN 'BAD_JSON' WHEN 1 THEN 'NOT_OBJECT' WHEN 2 THEN 'NO_ID'
         WHEN 3 THEN 'ID_NOT_STRING' WHEN 4 THEN 'NO_RELATION' WHEN 5 THEN 'UNKNOWN_RELATION'
         WHEN 6 THEN 'BAD_UTF8' END AS reason,
       CASE WHEN event_id % 97 >= 7 THEN event_type || '-' || CAST(user_id AS VARCHAR) END AS row_key
FROM events""")
def q_quarantine_rows(spark, sf_dir):
    """Every message with its verdict: reason NULL and a row key when good."""
    msgs = X.bad_messages(_events(spark, sf_dir))
    d = D.decode(msgs, K.default_catalog())
    return d.select(F.col("seq").alias("event_id"), "reason",
                    F.when(F.col("reason").isNull(), F.col("row_key")).alias("row_key"))


# The other query families register themselves on import.
from celltide.plans import q_ingest, q_jobs, q_logs, q_reports, q_windows  # noqa: E402,F401
