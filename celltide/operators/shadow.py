"""Device shadow and active devices.

The shadow of a device is the newest value of each field it has reported
(per field, so a message without a field keeps the older value) plus its
last-seen time.  One ``groupBy`` on the device id with ``max_by``: partial
aggregation sends one row per device and input partition through the
shuffle, however many messages a hot device sends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def device_shadow(decoded_good: DataFrame, fields: list[str], ts_col: str = "publish_time", reported: bool = False) -> DataFrame:
    """``id, last_seen, n_messages, f_<field>...`` (text of the newest value).

    ``reported`` adds the list of those ``fields`` that the device has sent at
    all, as a NULL value may also be one that was sent as ``null``.
    """
    order = F.struct(F.col(ts_col), F.col("seq"))
    obj = F.col("obj")
    aggs = [F.max(ts_col).alias("last_seen"), F.count(F.lit(1)).alias("n_messages")]
    if reported:
        sent = [F.when(F.bool_or(F.map_contains_key(obj, f)), F.lit(f)) for f in fields]
        aggs.append(F.array_compact(F.array(*sent)).alias("reported"))
    for f in fields:
        present = F.map_contains_key(obj, f)
        aggs.append(F.max_by(F.try_element_at(obj, F.lit(f)).cast("string"),
                             F.when(present, order)).alias(f"f_{f}"))
    return decoded_good.groupBy(F.col("row_key").alias("id")).agg(*aggs)


def active_devices(shadow: DataFrame, period: str, now: Column) -> DataFrame:
    """Devices seen within ``period`` before ``now``."""
    return shadow.select("id", "last_seen",
                         (F.col("last_seen") >= now - F.expr(f"INTERVAL {period}")).alias("active"))
