"""Sparse wide-column cells.

A good message becomes one row per key: ``(row_key, family, qualifier,
value, cell_ts, seq, relation)``; the value is the canonical text of the JSON
value (``cast(variant AS STRING)``), and a JSON ``null`` stays a cell whose
value is NULL (present-null is not missing).  Cell versions are append-only;
reads pick the newest version per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CF_PAYLOAD = "cf1"
CF_META = "cf2"


def to_cells(decoded_good: DataFrame, cell_ts: Column | str = "publish_time",
             include_key: bool = True, meta_family: bool = True,
             event_time_field: str = "timestamp") -> DataFrame:
    """P4-P7 (P8 with ``include_key=False, meta_family=False``).

    One ``explode`` over an array built per message: every key of the object
    in ``cf1`` and, if ``meta_family``, the relation once more in ``cf2``.
    ``cell_ts`` is the version time: ``current_timestamp()`` for ingest time,
    or a source column (publish time) for a repeatable replay.  ``event_ts``
    is the payload's own time field, parsed (NULL when absent or unparsable);
    the payload text of that field is kept as a cell as well.
    """
    ts = F.col(cell_ts) if isinstance(cell_ts, str) else cell_ts
    event_ts = F.try_variant_get(F.try_element_at(F.col("obj"), F.lit(event_time_field)), "$", "timestamp")
    entries = F.transform(
        F.map_entries("obj"),
        lambda e: F.struct(F.lit(CF_PAYLOAD).alias("family"), e["key"].alias("qualifier"),
                           e["value"].cast("string").alias("value")))
    if not include_key:
        entries = F.filter(entries, lambda c: c["qualifier"] != "id")
    if meta_family:
        entries = F.concat(entries, F.array(F.struct(
            F.lit(CF_META).alias("family"), F.lit("relation").alias("qualifier"),
            F.col("relation").alias("value"))))
    return (decoded_good
            .select("row_key", "relation", "seq", ts.alias("cell_ts"), event_ts.alias("event_ts"),
                    F.explode(entries).alias("c"))
            .select("row_key", F.col("c.family").alias("family"), F.col("c.qualifier").alias("qualifier"),
                    F.col("c.value").alias("value"), "cell_ts", "event_ts", "seq", "relation",
                    F.to_date("cell_ts").alias("ingest_date")))


def _version_order() -> Column:
    return F.struct("cell_ts", "seq")


def latest_cells(cells: DataFrame) -> DataFrame:
    """A5: newest version of each (row_key, family, qualifier).

    ``max_by`` keeps a map-side partial aggregate, so only one row per cell and
    input partition crosses the shuffle, however many versions a hot row has.
    Ties on ``cell_ts`` (one micro-batch) are broken by ``seq``.
    """
    return (cells.groupBy("row_key", "family", "qualifier")
            .agg(F.max_by("value", _version_order()).alias("value"),
                 F.max("cell_ts").alias("cell_ts")))


def cell_versions(cells: DataFrame, n: int = 3) -> DataFrame:
    """A6 + W1: newest ``n`` versions per cell, with the cell's version count.

    ``row_number() <= n`` alone lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so a hot cell ships at most ``n`` rows per input
    partition; the version count is a separate, map-side combined ``groupBy``.
    Both sides are keyed by the cell, so the join between them is small.
    """
    key = ["row_key", "family", "qualifier"]
    ordered = Window.partitionBy(*key).orderBy(F.col("cell_ts").desc(), F.col("seq").desc())
    top = (cells.withColumn("version", F.row_number().over(ordered))
           .where(F.col("version") <= n))
    counts = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("n_versions"))
    return top.join(counts, key).select(*key, "version", "value", "n_versions")


def row_maps(latest: DataFrame) -> DataFrame:
    """``row_key, cells MAP<family, MAP<qualifier, value>>`` of newest values.

    One group per row key holding at most one entry per (family, qualifier),
    so the group is bounded by the schema width, not by the message count.
    """
    grouped = latest.groupBy("row_key").agg(
        F.collect_list(F.struct("family", "qualifier", "value")).alias("c"))
    families = F.array_distinct(F.transform("c", lambda x: x["family"]))
    nested = F.map_from_entries(F.transform(families, lambda fam: F.struct(
        fam.alias("key"),
        F.map_from_entries(F.transform(F.filter("c", lambda x: x["family"] == fam),
                                       lambda x: F.struct(x["qualifier"], x["value"]))).alias("value"))))
    return grouped.select("row_key", nested.alias("cells"))


def pivot_latest(latest: DataFrame, qualifiers: list[str], family: str = CF_PAYLOAD) -> DataFrame:
    """Latest values of one family as columns; the column list comes from the
    catalog, so no extra job is run to find the pivot values."""
    return (latest.where(F.col("family") == family)
            .groupBy("row_key").pivot("qualifier", qualifiers).agg(F.first("value")))
