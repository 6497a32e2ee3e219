"""Catalog-driven views: typed relation view (P11) and conformance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from celltide.sources.catalog import DECLARED_TYPES, Catalog


def _typed_text(text: Column, declared: str) -> Column:
    """Typed read of a value's canonical text, NULL when it does not convert.

    An INTEGER must be integral as written (``1.9`` is none); an unknown
    declared type is read as text.
    """
    spark_type = DECLARED_TYPES.get(declared.upper(), "string")
    if spark_type == "string":
        return text
    value = text.try_cast(spark_type)
    return F.when(text.rlike(r"^[+-]?\d+$"), value) if spark_type == "int" else value


def _typed(v: Column, declared: str) -> Column:
    """Typed read of a VARIANT value: its kind must fit (text for STRING and TIMESTAMP, a number for FLOAT and
    INTEGER), and then its canonical text is read as a stored cell is."""
    spark_type = DECLARED_TYPES.get(declared.upper())
    text = v.cast("string")
    if spark_type is None:
        return text
    is_text = F.schema_of_variant(v) == "STRING"
    is_number = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$")
    return F.when(is_text if spark_type in ("string", "timestamp") else is_number, _typed_text(text, declared))


def typed_view(decoded_good: DataFrame, fields: list[tuple[str, str]],
               keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One column per catalog field, typed by its declared type (``try`` casts:
    a value that does not convert becomes NULL instead of failing the job).
    Field list comes from the catalog, so no pass over the data finds it."""
    cols = [_typed(F.try_element_at(F.col("obj"), F.lit(name)), t).alias(name) for name, t in fields]
    return decoded_good.select(*keep, *cols)


def typed_latest(latest: DataFrame, fields: list[tuple[str, str]], family: str = "cf1") -> DataFrame:
    """P11 on the store: newest cell values pivoted to one column per catalog
    field (the pivot values come from the catalog, so no extra pass finds
    them), then read by the rule of ``typed_view``.  A stored cell no longer
    tells ``"12"`` from ``12``: as FLOAT or INTEGER both are read."""
    from celltide.operators.cells import pivot_latest
    names = [n for n, _ in fields]
    wide = pivot_latest(latest, names, family)
    return wide.select("row_key", *[_typed_text(F.col(n), t).alias(n) for n, t in fields])


def conformance(decoded_good: DataFrame, catalog: Catalog) -> DataFrame:
    """Per (relation, field) counts of messages where a catalog field is
    missing, a key is not in the catalog (extra), or a value does not convert
    to its declared type (badly_typed).  JSON ``null`` is present, not bad.

    Plan: aggregate before meeting the catalog.  Every message explodes into
    its keys plus one marker entry, and each value is tested against all
    declared types, so that no field needs its type to be counted.  The
    catalog's fields join the same ``groupBy(relation, field)`` as rows that
    count nothing: one exchange of partial counts, a row for each relation,
    field and task.  A window over those few rows gives each field its
    relation's number of messages.
    """
    marker = "\u0000messages"
    entries = F.concat(F.map_entries("obj"),
                       F.array(F.struct(F.lit(marker).alias("key"), F.lit(None).cast("variant").alias("value"))))
    keys = decoded_good.select("relation", F.explode(entries).alias("e")) \
        .select("relation", F.col("e.key").alias("field"), F.col("e.value").alias("v"))
    given = F.col("v").isNotNull() & ~F.expr("is_variant_null(v)")
    bad = {t: F.when(given & _typed(F.col("v"), t).isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long") for t in DECLARED_TYPES}
    none = F.lit(0).cast("long")
    counted = keys.select("relation", "field", F.lit(None).cast("string").alias("type"), F.lit(1).cast("long").alias("present"),
                          *(c.alias(t) for t, c in bad.items()))
    declared = catalog.to_df(decoded_good.sparkSession).select("relation", F.col("name").alias("field"), "type", none.alias("present"), *(none.alias(t) for t in bad))
    counts = counted.unionByName(declared).groupBy("relation", "field") \
        .agg(F.max("type").alias("type"), *(F.sum(c).alias(c) for c in ("present", *bad)))
    messages = F.max(F.when(F.col("field") == marker, F.col("present"))).over(Window.partitionBy("relation"))
    rows = counts.withColumn("n_msgs", messages).where((F.col("field") != marker) & (F.col("n_msgs") > 0))
    known, badly = F.col("type").isNotNull(), none
    for t in bad:
        badly = F.when(F.col("type") == t, F.col(t)).otherwise(badly)
    return rows.select("relation", "field", F.when(known, F.col("n_msgs") - F.col("present")).otherwise(none).alias("missing"),
                       F.when(known, none).otherwise(F.col("present")).alias("extra"), badly.alias("badly_typed"))
