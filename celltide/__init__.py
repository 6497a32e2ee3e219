"""celltide: device-telemetry ingest and query functions on Spark DataFrames.

Every public operator is a plain ``DataFrame -> DataFrame`` function (usable
with ``df.transform``) built from Spark SQL built-ins; nothing registers a
Python UDF.  Batch jobs and Structured Streaming share the same functions.
"""

from celltide.session import configure, get_session

__all__ = ["configure", "get_session"]
