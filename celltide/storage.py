"""Locations in the shared folder named by ``spark.checkpoint.dir``.

Written tables (cells, quarantine, routed relations) and streaming
checkpoints live under that folder so that every executor and a restarted
driver see them.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); fails when none is named."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and sc._jsc.sc().getCheckpointDir().isDefined():
        root = sc._jsc.sc().getCheckpointDir().get()
    if not root:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share, "
                           "e.g. --conf spark.checkpoint.dir=hdfs:///checkpoints")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_location(spark: SparkSession, kind: str) -> str:
    """A fresh, never reused folder under the shared root."""
    return f"{shared_root(spark)}/celltide/{kind}/{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` through the Hadoop file system API."""
    hpath, fs = _file_system(spark, path)
    return bool(fs.delete(hpath, True))


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    hpath, fs = _file_system(spark, source)
    if not fs.rename(hpath, _file_system(spark, target)[0]):
        raise RuntimeError(f"cannot rename {source} to {target}")


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop glob, sorted."""
    hpath, fs = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(hpath) or [])


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    (a, fs), (b, to) = _file_system(spark, source), _file_system(spark, target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, to, b, False, conf)


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    hpath, fs = _file_system(spark, path)
    fs.setTimes(hpath, millis, -1)


def list_names(spark: SparkSession, path: str) -> dict[str, int]:
    """Names directly under ``path`` and when each was modified (ms); one listing, empty if there is no such folder."""
    hpath, fs = _file_system(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(hpath)} if fs.exists(hpath) else {}


def leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders under ``path`` that hold data files, relative to it; names with ``_`` or ``.`` in front are none."""
    hpath, fs = _file_system(spark, path)
    if not fs.exists(hpath):
        return []
    root, found, files = fs.makeQualified(hpath).toString().rstrip("/"), set(), fs.listFiles(hpath, True)
    while files.hasNext():
        folder, name = files.next().getPath().toString().removeprefix(f"{root}/").rpartition("/")[::2]
        if folder and not any(x.startswith(("_", ".")) for x in (*folder.split("/"), name)):
            found.add(folder)
    return sorted(found)


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small UTF-8 file whole; None if there is none."""
    hpath, fs = _file_system(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small UTF-8 file, whole; False, and no change, if there is one of that name already.

    The name appears by a rename that does not replace, which is atomic on HDFS.  A store without such a rename
    needs a single writer.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath, fs = _file_system(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(hidden)
    out.write(bytearray(text, "utf-8"))
    out.close()
    whole = [fs.makeQualified(p) for p in (hidden, hpath)]
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole[1].toUri(), conf).rename(*whole, none)
    except Py4JJavaError as e:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def list_subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the immediate sub-folders of ``path`` (partition listing)."""
    hpath, fs = _file_system(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())
