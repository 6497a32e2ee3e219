"""Log and label queries: parse, panels, volume, patterns, age limits, relabel, audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from celltide.functions.relabel import Rule, relabel
from celltide.operators import labels as LB
from celltide.operators import logs as LG
from celltide.operators import templates as TM
from celltide.plans.registry import query
from celltide.sources import fixtures as X

# Log lines rebuilt in SQL (same rule as ``fixtures.log_lines``).
LOG_CTE = r"""l AS (
  SELECT event_id, ts, user_id, level, msg,
         'level=' || level || ' ts=' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
           || ' caller=main.go:' || CAST(100 + event_id % 90 AS VARCHAR)
           || ' msg="' || replace(replace(msg, '\', '\\'), '"', '\"') || '"' AS line,
         CASE WHEN user_id % 3 < 2 THEN 'verne' ELSE 'observe' END AS namespace,
         CASE WHEN user_id % 2 = 0 THEN 'listener' ELSE 'vernemq' END AS container
  FROM (SELECT *,
          CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'debug' ELSE 'info' END AS level,
          'user ' || CAST(user_id AS VARCHAR) || ' value ' || CAST(value AS VARCHAR)
            || CASE WHEN event_id % 41 = 0 THEN ' saw "level=error"' ELSE '' END AS msg
        FROM events))"""


def _logs(spark, sf_dir):
    return X.log_lines(X.load_events(spark, sf_dir))


@query("log_parse", "WITH " + LOG_CTE + """
SELECT event_id, level, ts, 'main.go:' || CAST(100 + event_id % 90 AS VARCHAR) AS caller, msg FROM l""")
def q_log_parse(spark, sf_dir):
    """S13 + P17: logfmt lines parsed back to level, time, caller, message."""
    p = LG.parse_logs(_logs(spark, sf_dir))
    return p.select(F.col("seq").alias("event_id"), "level", F.col("ts").cast("timestamp_ntz").alias("ts"),
                    "caller", "msg")


def _panel_sql(level: str) -> str:
    return "WITH " + LOG_CTE + f""",
now AS (SELECT max(ts) AS t FROM events)
SELECT event_id, ts, line FROM l, now
WHERE namespace = 'verne' AND container = 'listener' AND contains(line, 'level={level}')
  AND ts >= now.t - INTERVAL 6 HOUR AND ts <= now.t"""


def _panel(level: str):
    def run(spark, sf_dir):
        """P13-P15 + O1: dashboard panel, label selector + raw-line contains, last 6 h, newest first."""
        now = LG.newest(X.load_events(spark, sf_dir), "ts")
        p = LG.panel(_logs(spark, sf_dir), {"namespace": "verne", "container": "listener"}, contains=f"level={level}", now=now)
        return p.select(F.col("seq").alias("event_id"), F.col("arrival_ts").cast("timestamp_ntz").alias("ts"),
                        "line")
    return run


for _lvl in ("debug", "error", "info"):
    query(f"log_panel_{_lvl}", _panel_sql(_lvl))(_panel(_lvl))


@query("log_volume", "WITH " + LOG_CTE + """
SELECT time_bucket(INTERVAL '15 minutes', ts) AS bucket, namespace, container, level,
       CAST(count(*) AS BIGINT) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS bytes
FROM l GROUP BY 1, 2, 3, 4""")
def q_log_volume(spark, sf_dir):
    """Lines and bytes per 15 minutes and label set."""
    v = LG.volume(LG.parse_logs(_logs(spark, sf_dir)), "15 minutes", ("namespace", "container", "level"))
    return v.select(F.col("bucket").cast("timestamp_ntz").alias("bucket"), "namespace", "container", "level",
                    "lines", "bytes")


@query("log_patterns", "WITH " + LOG_CTE + r"""
SELECT template, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT regexp_replace(regexp_replace(regexp_replace(line,
           '\d{4}-\d{2}-\d{2}T[0-9:.]+Z', '<ts>', 'g'), '0x[0-9a-fA-F]+', '<hex>', 'g'),
           '\d+(?:\.\d+)?', '<num>', 'g') AS template FROM l)
GROUP BY template""")
def q_log_patterns(spark, sf_dir):
    """Line templates (numbers, times and hex masked) by frequency."""
    return LG.patterns(_logs(spark, sf_dir))


@query("log_templates", """
SELECT CASE WHEN user_id % 3 < 2 THEN 'verne' ELSE 'observe' END AS namespace,
       CASE event_type WHEN 'signup' THEN 'new user <*> signed up' WHEN 'purchase' THEN 'order <*> paid by <*>'
            WHEN 'error' THEN CASE WHEN event_id % 2 = 0 THEN 'cannot open <*> permission denied' ELSE 'cannot open <*> not found' END
            WHEN 'view' THEN 'page <*> viewed' ELSE 'link <*> was clicked' END AS template, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2""")
def q_log_templates(spark, sf_dir):
    """Templates of messages whose variable parts are words and paths, per namespace."""
    return TM.mine_templates(X.worded_lines(X.load_events(spark, sf_dir)), by=("namespace",))


@query("reject_old", """
SELECT CAST(count(*) FILTER (WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 168 HOUR) AS BIGINT) AS accepted,
       CAST(count(*) FILTER (WHERE ts < (SELECT max(ts) FROM events) - INTERVAL 168 HOUR) AS BIGINT) AS rejected
FROM events""")
def q_reject_old(spark, sf_dir):
    """Lines older than 168 h when the batch arrives (at the newest line) are rejected."""
    logs = _logs(spark, sf_dir)
    flagged = LG.reject_old(logs, "arrival_ts", F.lit(LG.newest(logs, "arrival_ts")), "168 hours")
    return flagged.agg(F.count_if(~F.col("rejected")).alias("accepted"),
                       F.count_if(F.col("rejected")).alias("rejected"))


@query("retention", """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS event_date, CAST(count(*) AS BIGINT) AS n FROM events
WHERE CAST(ts AS DATE) >= CAST((SELECT max(ts) FROM events) AS DATE) - INTERVAL 15 DAY
GROUP BY 1""")
def q_retention(spark, sf_dir):
    """P25: rows of the days kept by a 15-day retention, per day."""
    ev = X.load_events(spark, sf_dir)
    kept = LG.retention(ev, LG.newest(ev, "ts"), days=15, ts_col="ts")
    return kept.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("event_date")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("delivery_audit", """
SELECT CASE WHEN event_id % 101 = 0 THEN 'not_queued' WHEN event_id % 53 = 0 THEN 'failed'
            ELSE 'published' END AS outcome, CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1""")
def q_delivery_audit(spark, sf_dir):
    """Outcome of every message from the bridge's step log, keyed by payload hash."""
    return LG.delivery_audit(X.delivery_steps(X.load_events(spark, sf_dir)))


# ------------------------------------------------------------ labels

LABEL_CTE = """p AS (
  SELECT event_id, user_id,
         CASE WHEN user_id % 3 < 2 THEN 'verne' ELSE 'observe' END AS ns,
         CASE WHEN user_id % 2 = 0 THEN 'listener' ELSE 'vernemq' END AS ctr,
         CASE user_id % 5 WHEN 0 THEN 'Running' WHEN 1 THEN 'Running' WHEN 2 THEN 'Pending'
           WHEN 3 THEN 'Succeeded' ELSE 'Failed' END AS phase,
         CASE user_id % 4 WHEN 0 THEN 'backend' WHEN 1 THEN 'edge' END AS tier
  FROM events)"""


@query("relabel", "WITH " + LABEL_CTE + """
SELECT event_id, ns AS namespace, ctr || '-' || CAST(user_id AS VARCHAR) AS pod, ctr AS container, ctr AS app,
       ns || '/' || ctr AS job, '/var/log/pods/*uid-' || CAST(user_id AS VARCHAR) || '/' || ctr || '/*.log' AS path,
       CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'containerd' END AS container_runtime,
       'kubernetes.default.svc:443' AS address
FROM p""")
def q_relabel(spark, sf_dir):
    """Pod log target rules (copy, join + template, regex capture, constant)."""
    md = X.pod_metadata(X.load_events(spark, sf_dir))
    out = relabel(md, LB.POD_LOG_RULES + [LB.CONSTANT_ADDRESS_RULE])
    lab = F.col("labels")
    return out.select(F.col("seq").alias("event_id"), lab["namespace"].alias("namespace"),
                      lab["pod"].alias("pod"), lab["container"].alias("container"), lab["app"].alias("app"),
                      lab["job"].alias("job"), lab["__path__"].alias("path"),
                      lab["container_runtime"].alias("container_runtime"), lab["__address__"].alias("address"))


@query("relabel_filter", "WITH " + LABEL_CTE + """
SELECT event_id, ns AS namespace, phase FROM p
WHERE ns = 'verne' AND phase NOT IN ('Pending', 'Succeeded', 'Failed', 'Completed')""")
def q_relabel_filter(spark, sf_dir):
    """Keep targets of namespace ``verne``, drop pods that are not running."""
    md = X.pod_metadata(X.load_events(spark, sf_dir))
    keep_ns = Rule(action="keep", source_labels=("__meta_kubernetes_namespace",), regex="verne")
    out = relabel(md, [keep_ns, LB.DROP_FINISHED_PODS])
    return out.select(F.col("seq").alias("event_id"),
                      F.col("labels")["__meta_kubernetes_namespace"].alias("namespace"),
                      F.col("labels")["__meta_kubernetes_pod_phase"].alias("phase"))


@query("relabel_address", """
SELECT event_id,
       '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || CASE WHEN user_id % 4 = 0 THEN ':9100' ELSE ':8080' END
         AS address,
       '10.0.0.' || CAST(user_id % 250 AS VARCHAR) || ':8080' AS discovered
FROM events""")
def q_relabel_address(spark, sf_dir):
    """P20: address rewrite from a port annotation; without one the regex does not match
    and the address stays as discovered."""
    md = X.pod_metadata(X.load_events(spark, sf_dir))
    keep = Rule(source_labels=("__address__",), target_label="discovered")
    out = relabel(md, [keep, LB.ADDRESS_PORT_RULE])
    return out.select(F.col("seq").alias("event_id"), F.col("labels")["__address__"].alias("address"),
                      F.col("labels")["discovered"].alias("discovered"))


@query("labelmap", "WITH " + LABEL_CTE + """
SELECT event_id, 'app_kubernetes_io_name' AS label, ctr AS value FROM p
UNION ALL SELECT event_id, 'tier', tier FROM p WHERE tier IS NOT NULL""")
def q_labelmap(spark, sf_dir):
    """Pod labels renamed by pattern; internal ``__`` labels dropped afterwards."""
    md = X.pod_metadata(X.load_events(spark, sf_dir))
    out = relabel(md, [LB.POD_LABELMAP], drop_internal=True)
    # explode_outer: a plain explode makes the optimizer infer a size(labels) > 0
    # filter and push it below the projections, evaluating the rules twice
    return (out.select(F.col("seq").alias("event_id"), F.explode_outer("labels").alias("label", "value"))
            .where(F.col("label").isNotNull()))
