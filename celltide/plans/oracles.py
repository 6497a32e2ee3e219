"""DuckDB SQL that rebuilds each query's expected result from ``events``.

The fixture rules of ``celltide.sources.fixtures`` are restated in SQL here:
an independent statement of the same semantics, used as the correctness
oracle at sf0.01.  Float results are rounded to 6 decimals on both sides.
"""

# Common table expressions shared by several oracles.
EV = r"""ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         event_type || '-' || CAST(user_id AS VARCHAR) AS row_key,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text,
         regexp_replace(CAST(value AS VARCHAR), '\.0$', '') AS value_text
  FROM events)"""

PAYLOAD = r"""'{"id":"' || row_key || '","timestamp":"' || ts_text || '","value":' || CAST(value AS VARCHAR)
  || ',"k":' || CAST(k AS VARCHAR) || ',"relation":"' || event_type || '"}'"""

# Cells of the sparse messages: k omitted when event_id % 3 = 0, value when % 5 = 0,
# k present-null when % 7 = 0.
SPARSE_CELLS = r"""cells AS (
  SELECT row_key, 'cf1' AS family, 'id' AS qualifier, row_key AS value, event_id, ts FROM ev
  UNION ALL SELECT row_key, 'cf1', 'timestamp', ts_text, event_id, ts FROM ev
  UNION ALL SELECT row_key, 'cf1', 'value', value_text, event_id, ts FROM ev WHERE event_id % 5 <> 0
  UNION ALL SELECT row_key, 'cf1', 'k', CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(k AS VARCHAR) END,
                   event_id, ts FROM ev WHERE event_id % 7 = 0 OR event_id % 3 <> 0
  UNION ALL SELECT row_key, 'cf1', 'relation', event_type, event_id, ts FROM ev
  UNION ALL SELECT row_key, 'cf2', 'relation', event_type, event_id, ts FROM ev)"""

LATEST = r"""latest AS (
  SELECT row_key, family, qualifier, arg_max_null(value, (ts, event_id)) AS value
  FROM cells GROUP BY row_key, family, qualifier)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
