"""Message decoding with quarantine (P1-P3, P10, J1, J2; S5 read side).

A message is ``payload BINARY`` plus source columns.  Decoding is one
narrow projection: bytes -> UTF-8 text -> VARIANT -> object map, the row key
from ``id`` and the relation from the body, and a ``reason`` that is NULL for
good messages.  A catalog of checked size goes into the plan as a literal
list of names, so the check is one more expression and moves no row.  A larger
one is joined on (relation, salt), with the messages of each relation, and those
without one, dealt over ``SALTS`` keys.
Nothing is dropped: every bad message keeps its payload and a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.sources.catalog import Catalog

#: Keys over which the join with a large catalog deals each relation; the catalog is repeated as often.
SALTS = 32


def _salted(messages: DataFrame, relation: str) -> DataFrame:
    """``_salt`` from what tells messages apart, the same in each attempt of a task."""
    telling = [c for c in ("payload", "message_id", "seq", "publish_time") if c in messages.columns]
    return messages.withColumn("_salt", F.pmod(F.xxhash64(*(telling or [relation])), F.lit(SALTS)))


def _with_known(messages: DataFrame, catalog: Catalog, relation: str = "relation") -> DataFrame:
    """``messages`` with ``_known``: whether the catalog has their relation."""
    if catalog.fits_in_plan():
        return messages.withColumn("_known", F.coalesce(F.col(relation).isin(catalog.names()), F.lit(False)))
    names = catalog.relations_df(messages.sparkSession).withColumnRenamed("relation", relation) \
        .select(relation, F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("_salt"), F.lit(True).alias("_known"))
    joined = _salted(messages, relation).join(names, [relation, "_salt"], "left").drop("_salt")
    return joined.select(*messages.columns, F.coalesce("_known", F.lit(False)).alias("_known"))


def decode(messages: DataFrame, catalog: Catalog | None = None) -> DataFrame:
    """Add ``row_key, relation, obj (MAP<STRING,VARIANT>), reason`` to messages.

    Needs ``spark.sql.variant.allowDuplicateKeys=true`` (``configure``) so a
    repeated key keeps its last value, as a dict would.
    """
    valid = F.col("_utf8")
    parsed = F.col("_v")
    # parse once; the object map and every check below reuse the VARIANT
    df = (messages
          .withColumn("_utf8", F.expr("is_valid_utf8(payload)"))
          .withColumn("_v", F.expr("try_parse_json(CASE WHEN _utf8 THEN cast(payload AS STRING) END)"))
          .withColumn("obj", F.expr("try_cast(_v AS MAP<STRING, VARIANT>)")))
    has_id = F.map_contains_key(F.col("obj"), "id")
    id_v = F.try_element_at(F.col("obj"), F.lit("id"))
    id_is_text = F.coalesce(F.schema_of_variant(id_v) == "STRING", F.lit(False))
    has_rel = F.map_contains_key(F.col("obj"), "relation")
    rel_v = F.try_element_at(F.col("obj"), F.lit("relation"))
    rel_is_text = F.coalesce(F.schema_of_variant(rel_v) == "STRING", F.lit(False))
    df = (df
          .withColumn("row_key", F.when(id_is_text, id_v.cast("string")))
          .withColumn("relation", F.when(rel_is_text, rel_v.cast("string"))))
    known = F.lit(True)
    if catalog is not None:
        df = _with_known(df, catalog)
        known = F.col("_known")
    reason = (F.when(~valid, "BAD_UTF8")
              .when(parsed.isNull(), "BAD_JSON")
              .when(F.col("obj").isNull(), "NOT_OBJECT")
              .when(~has_id, "NO_ID")
              .when(~id_is_text, "ID_NOT_STRING")
              .when(~has_rel, "NO_RELATION")
              .when(~rel_is_text, "RELATION_NOT_STRING")
              .when(~known, "UNKNOWN_RELATION"))
    df = df.withColumn("reason", reason)
    # a generated row: filters on the reason stay above it, else the optimizer would copy the parse into each of them
    found = ("obj", "row_key", "relation", "reason")
    return df.select(*[c for c in messages.columns if c not in found], F.inline(F.array(F.struct(*found))))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("reason").isNull()).drop("reason")


def quarantined(decoded: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Bad messages with their original bytes and the reason: ``BAD_UTF8, BAD_JSON, NOT_OBJECT, NO_ID,
    ID_NOT_STRING, NO_RELATION, RELATION_NOT_STRING`` or ``UNKNOWN_RELATION``, the first that holds."""
    keep = [c for c in ("seq", "message_id", "topic", "publish_time", "attributes", "payload", "reason", *also)
            if c in decoded.columns]
    return decoded.where(F.col("reason").isNotNull()).select(*keep)


def quarantine_counts(decoded: DataFrame) -> DataFrame:
    """``reason, n`` over the quarantined messages."""
    return quarantined(decoded).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def known_relation(messages: DataFrame, catalog: Catalog, col: str = "relation") -> DataFrame:
    """Messages whose relation is in the catalog."""
    return _with_known(messages, catalog, col).where("_known").drop("_known")


def unknown_relation(messages: DataFrame, catalog: Catalog, col: str = "relation") -> DataFrame:
    """Messages whose relation is not in the catalog, those without one among them."""
    return _with_known(messages, catalog, col).where("not _known").drop("_known")


def decode_envelopes(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """S5 read side: REST publish bodies -> one message row per entry.

    ``{"messages":[{"data": base64, "attributes": {...}}]}``; line breaks in
    the base64 text are stripped before decoding.
    """
    schema = "messages ARRAY<STRUCT<data: STRING, attributes: MAP<STRING, STRING>>>"
    return (bodies
            .select(F.inline(F.from_json(F.col(body_col), schema).getField("messages")))
            .select(F.unbase64(F.regexp_replace("data", r"[\r\n]", "")).alias("payload"),
                    F.col("attributes")))


def encode_envelope(messages: DataFrame) -> DataFrame:
    """S5 write side: one publish body per message (``to_json`` of the envelope)."""
    entry = F.struct(F.base64("payload").alias("data"), F.col("attributes"))
    return messages.select(F.to_json(F.struct(F.array(entry).alias("messages"))).alias("body"))
