"""Topic subscription, forwarding and producer-side serialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.text import topic_matches


def subscribe(messages: DataFrame, filters: list[str], topic_col: str = "topic") -> DataFrame:
    """S3: keep messages whose topic matches any MQTT filter (``+``, ``#``)."""
    return messages.where(topic_matches(F.col(topic_col), filters))


def forward_records(messages: DataFrame, target_topic: str) -> DataFrame:
    """Payload bytes unchanged as a Kafka-shaped record (key, value, topic, headers).

    Writing these with ``writeStream`` and a checkpoint replaces the per-message
    publish call; the sink reports delivery per micro-batch.
    """
    return messages.select(
        F.col("message_id").cast("binary").alias("key"),
        F.col("payload").alias("value"),
        F.lit(target_topic).alias("topic"),
        F.transform(F.map_entries("attributes"),
                    lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value"))
                    ).alias("headers"),
    )


def with_relation_json(df: DataFrame, fields: list[str], relation: Column) -> Column:
    """JSON text of the given fields plus ``relation``.

    ``to_json`` writes timestamps with millisecond precision; pass ISO text
    columns instead when more digits must survive.
    """
    return F.to_json(F.struct(*[F.col(f) for f in fields], relation.alias("relation")))
