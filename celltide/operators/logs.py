"""Log lines: parse, panels, volume, patterns, age limits, delivery audit.

Covers S13, P13-P15, P17, P24, P25, O1, A8, A9 and J5.  A log frame has
``line`` plus label columns (``namespace``, ``container``, ...) and an
``arrival_ts``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions import logfmt

# Fixed value: where the pod log layout names namespace, pod and container.
POD_LOG_PATH = r"/pods/([^_/]+)_([^_/]+)_([^/]+)/([^/]+)/[^/]*$"


def parse_logs(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Add ``level, ts, caller, msg`` parsed from the logfmt line."""
    return lines.withColumn("_p", logfmt.parse(F.col(line_col))).select("*", "_p.*").drop("_p")


def read_log_files(spark, path: str, label_pattern: str | None = None) -> DataFrame:
    """Container log files as lines, labels from the file path.

    With the ``/var/log/pods/<namespace>_<pod>_<uid>/<container>/N.log``
    layout, namespace, pod and container come out of ``_metadata.file_path``.
    """
    pat = label_pattern or POD_LOG_PATH
    df = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    return df.select(
        "line", "file",
        F.regexp_extract("file", pat, 1).alias("namespace"),
        F.regexp_extract("file", pat, 2).alias("pod"),
        F.regexp_extract("file", pat, 4).alias("container"),
    )


def stream_log_files(spark, path: str, label_pattern: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """S13 as a stream: new log files are picked up per micro-batch, labels
    from ``_metadata.file_path`` as in ``read_log_files``."""
    pat = label_pattern or POD_LOG_PATH
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                             F.current_timestamp().alias("arrival_ts"))
    return df.select("line", "file", "arrival_ts",
                     F.regexp_extract("file", pat, 1).alias("namespace"),
                     F.regexp_extract("file", pat, 2).alias("pod"),
                     F.regexp_extract("file", pat, 4).alias("container"))


def newest(df: DataFrame, time_col: str) -> dt.datetime:
    """Latest time in ``df``: a ``now`` for recorded data (one row reaches the driver)."""
    return df.agg(F.max(time_col)).first()[0]


def panel(logs: DataFrame, selector: dict[str, str], contains: str | None = None, *,
          now: dt.datetime, since: dt.timedelta = dt.timedelta(hours=6), limit: int | None = None,
          time_col: str = "arrival_ts", date_col: str | None = None) -> DataFrame:
    """P13-P15 + O1: label equality, raw-line substring, time range, newest first.

    ``contains`` tests the raw line, not the parsed level: a message that
    quotes ``level=error`` matches the error panel too.  The range is
    ``now - since`` to ``now``, as literals on the stored column, so that it
    reaches the scan; ``date_col`` names a date partition to prune by.  All
    lines are returned unless a ``limit`` is asked for, which makes the sort a
    per-partition top-n.
    """
    cond = F.lit(True)
    for k, v in selector.items():
        cond = cond & (F.col(k) == v)
    if contains is not None:
        cond = cond & F.col("line").contains(contains)
    cond = cond & F.col(time_col).between(F.lit(now - since), F.lit(now))
    if date_col:
        cond = cond & F.col(date_col).between(F.lit((now - since).date()), F.lit(now.date()))
    lines = logs.where(cond).orderBy(F.col(time_col).desc(), F.col("seq").asc())
    return lines if limit is None else lines.limit(limit)


def write_logs(logs: DataFrame, path: str, time_col: str = "arrival_ts") -> None:
    """Store log lines by day (``log_date``), in time order within files."""
    (logs.withColumn("log_date", F.to_date(time_col)).hint("rebalance", "log_date")
     .sortWithinPartitions("log_date", time_col).write.mode("append").partitionBy("log_date").parquet(path))


def volume(logs: DataFrame, every: str = "15 minutes",
           labels: tuple[str, ...] = ("namespace", "container", "level"),
           time_col: str = "arrival_ts") -> DataFrame:
    """Lines and bytes per label set and interval."""
    return (logs.groupBy(F.window(time_col, every).start.alias("bucket"), *labels)
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("line")).alias("bytes")))


# Masks that turn a line into its template, applied in order.
PATTERN_MASKS = [
    (r"\d{4}-\d{2}-\d{2}T[0-9:.]+Z", "<ts>"),
    (r"0x[0-9a-fA-F]+", "<hex>"),
    (r"\d+(?:\.\d+)?", "<num>"),
]


def template(line: Column) -> Column:
    for rx, rep in PATTERN_MASKS:
        line = F.regexp_replace(line, rx, rep)
    return line


def patterns(logs: DataFrame, k: int | None = None) -> DataFrame:
    """Line templates by frequency (ties by template text), the first ``k`` of them if asked for."""
    found = (logs.groupBy(template(F.col("line")).alias("template"))
             .agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.col("n").desc(), F.col("template")))
    return found if k is None else found.limit(k)


def reject_old(df: DataFrame, ts_col: str, arrival: Column, max_age: str = "168 hours") -> DataFrame:
    """Flag rows older than ``max_age`` at arrival (``rejected``); stateless,
    so callers write ``rejected`` rows to a side table instead of losing them.
    A row without a time cannot be shown to be old and is accepted."""
    old = F.col(ts_col) < arrival - F.expr(f"INTERVAL {max_age}")
    return df.withColumn("rejected", F.coalesce(old, F.lit(False)))


def retention(df: DataFrame, now: dt.datetime, days: int = 15, ts_col: str | None = None, date_col: str | None = None) -> DataFrame:
    """P25: keep whole days within ``days`` of ``now``, by the stored time or by a date
    partition; either predicate is a literal bound that reaches the scan."""
    first = now.date() - dt.timedelta(days=days)
    cond = F.lit(True)
    if date_col:
        cond = cond & (F.col(date_col) >= F.lit(first))
    if ts_col:
        cond = cond & (F.col(ts_col) >= F.lit(dt.datetime.combine(first, dt.time())))
    return df.where(cond)


def delivery_outcomes(steps: DataFrame, key: str = "msg_hash") -> DataFrame:
    """One outcome per message from its logged steps, with one ``groupBy``
    over the step log instead of three joins."""
    per_msg = steps.groupBy(key).agg(
        F.count_if(F.col("step") == "received").alias("received"),
        F.count_if(F.col("step") == "queued").alias("queued"),
        F.count_if(F.col("step") == "published").alias("published"),
        F.count_if(F.col("step") == "failed").alias("failed"))
    outcome = (F.when(F.col("received") == 0, "no_receipt")
               .when(F.col("published") > 0, "published")
               .when(F.col("failed") > 0, "failed")
               .when(F.col("queued") == 0, "not_queued")
               .otherwise("queued_only"))
    return per_msg.withColumn("outcome", outcome)


def delivery_audit(steps: DataFrame, key: str = "msg_hash") -> DataFrame:
    return delivery_outcomes(steps, key).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
