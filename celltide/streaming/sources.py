"""Streaming message sources.

Messages land as Parquet files (``payload BINARY`` survives intact; text
files would not).  A Kafka topic maps onto the same columns; the Kafka
connector is not part of this environment, so that path is untested here.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from celltide.storage import copy_file, glob_paths, list_names, set_modified

MESSAGE_SCHEMA = ("seq BIGINT, message_id STRING, topic STRING, payload BINARY, "
                  "publish_time TIMESTAMP, attributes MAP<STRING, STRING>")

#: Most messages of a landed file, and most files of a micro-batch.
FILE_ROWS, BATCH_FILES = 100_000, 64
#: Time slices that are kept apart, however small they are.
LEAST_SLICES = 8


def landed_messages(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded read of landed message files; ``maxFilesPerTrigger``
    bounds each micro-batch (back-pressure, T6)."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(landing_dir)


def kafka_messages(spark: SparkSession, bootstrap: str, topic: str,
                   max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S1/S2 on Kafka: value -> payload, headers -> attributes, offset -> seq."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return from_kafka(r.load())


def from_kafka(records: DataFrame) -> DataFrame:
    """Messages of Kafka records (a batch or a stream).

    Of headers with one name the last counts.  The message id is where the
    record stands (topic, partition, offset): a key names a device, not a
    message, and may be missing.
    """
    headers = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    last = F.filter(headers, lambda h, i: ~F.exists(F.slice(headers, i + 2, F.size(headers)), lambda later: later["key"] == h["key"]))
    attrs = F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return records.select(
        # partition-local offsets are unique only with the partition: fold it in
        (F.col("offset") * F.lit(1 << 16) + F.col("partition")).alias("seq"),
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("topic"), F.col("value").alias("payload"),
        F.col("timestamp").alias("publish_time"), attrs.alias("attributes"))


def land_messages(messages: DataFrame, landing_dir: str, files: int = 1, rows_per_file: int | None = None) -> int:
    """Write a batch of messages as landed files (used to feed a stream in tests): ``files`` of them, and more where these
    would hold over ``rows_per_file`` (``FILE_ROWS``) messages, so that no task writes or reads more, however large the batch.
    Their modification times ascend, so the file source reads them in the order of ``landed_files``.  Returns their number."""
    spark, before = messages.sparkSession, landed_files(messages.sparkSession, landing_dir)
    messages.repartition(max(files, -(-messages.count() // (rows_per_file or FILE_ROWS)))).write.mode("append").parquet(landing_dir)
    new = sorted(set(landed_files(spark, landing_dir)) - set(before))
    after = list_names(spark, landing_dir)[before[-1].rpartition("/")[2]] if before else 0
    _in_order(spark, new, after)
    return len(new)


def landed_files(spark: SparkSession, landing_dir: str) -> list[str]:
    """Files of ``land_messages`` in the order in which the file source reads them."""
    names = {n: t for n, t in list_names(spark, landing_dir).items() if n.startswith("part-")}
    return [f"{landing_dir.rstrip('/')}/{n}" for n in sorted(names, key=lambda n: (names[n], n))]


def files_per_batch(files: int, batches: int) -> int:
    """``maxFilesPerTrigger`` that deals ``files`` over ``batches`` micro-batches, over more if these would be large."""
    return max(1, min(-(-files // batches), BATCH_FILES))


def _in_order(spark: SparkSession, files: list[str], after: int = 0) -> None:
    """Give ``files`` modification times (ms) that ascend, later than ``after``: by these the file source orders them."""
    start = max(int(time.time() * 1000) - 1000 * len(files), after + 1000)
    for i, file in enumerate(files):
        set_modified(spark, file, start + 1000 * i)


def land_in_time_order(messages: DataFrame, landing_dir: str, days_per_slice: int = 8,
                       ts_col: str = "publish_time", key: str | None = None) -> int:
    """Land messages as time slices (see ``land_in_slices``), so a stream sees event time move
    forward between micro-batches, and each ``key``'s within them.

    A slice has ``days_per_slice`` days, or a multiple where the messages span many such slices
    (see ``slices_together``), so that the micro-batches follow the messages and not the years.
    """
    day = F.unix_date(F.to_date(ts_col))
    sizes = messages.groupBy(F.floor(day / days_per_slice).alias("slice")).count().agg(F.count(F.lit(1)).alias("slices"), F.max("count").alias("largest")).first()
    width = days_per_slice * slices_together(sizes["slices"], sizes["largest"] or 0)
    return land_in_slices(messages, landing_dir, F.floor(day / width), key, ts_col)


def slices_together(slices: int, largest: int) -> int:
    """How many of ``slices``, the largest of ``largest`` messages, to land as one: no more than leave ``LEAST_SLICES``
    of them, nor than hold the messages of ``BATCH_FILES`` full files."""
    return max(1, min(slices // LEAST_SLICES, BATCH_FILES * FILE_ROWS // max(1, largest)))


def land_in_slices(messages: DataFrame, landing_dir: str, slice_of: Column, key: str | None = None, order: str | None = None) -> int:
    """Land messages in one pass, in slices by the value of ``slice_of``, with modification times that ascend with it:
    the file source reads in that order.  Returns the number of files of a slice; with it as ``maxFilesPerTrigger``
    each micro-batch is one slice.

    A slice has a file for about every ``FILE_ROWS`` messages of the largest one, so that none is written or read by one
    task; a slice that fills fewer gets empty files for the rest.  Rows of a slice that agree in ``key``, if one is named,
    share a file; files are sorted by ``order``.
    """
    spark = messages.sparkSession
    sliced = messages.withColumn("slice", F.format_string("%020d", slice_of.cast("long")))
    sizes = sliced.groupBy("slice").count().agg(F.count(F.lit(1)).alias("slices"), F.max("count").alias("largest")).first()
    parts = max(1, -(-(sizes["largest"] or 0) // FILE_ROWS))
    if parts == 1:
        dealt = sliced.repartition("slice")
    else:
        # from the values of a row, so that a repeated task deals it the same way; maps have no hash
        telling = [key] if key else [f.name for f in messages.schema if not isinstance(f.dataType, MapType)]
        part = F.pmod(F.xxhash64(*telling), F.lit(parts))
        dealt = sliced.withColumn("part", part).repartition(sizes["slices"] * parts, "slice", "part").drop("part")
    dealt.sortWithinPartitions("slice", *([order] if order else [])).write.partitionBy("slice").parquet(landing_dir)
    slices: dict[str, list[str]] = {}
    for file in glob_paths(spark, f"{landing_dir}/slice=*/part-*"):
        slices.setdefault(file.rpartition("/")[0], []).append(file)
    each = max(map(len, slices.values()), default=1)
    if any(len(files) < each for files in slices.values()):
        empty = f"{landing_dir.rstrip('/')}-empty"
        spark.createDataFrame([], messages.schema).coalesce(1).write.mode("overwrite").parquet(empty)
        source = glob_paths(spark, f"{empty}/part-*")[0]
        for folder, files in slices.items():
            for i in range(each - len(files)):
                files.append(f"{folder}/part-empty-{i:05d}.parquet")
                copy_file(spark, source, files[-1])
    _in_order(spark, [file for folder in sorted(slices) for file in slices[folder]])
    return each
