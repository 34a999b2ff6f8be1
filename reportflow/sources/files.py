"""Folders and pointer files on the storage that the cluster shares, through the session's Hadoop FileSystem.

A pointer says which version of a table counts. It is one small file with the next number, created only if that number
is free, so of two writers that start from the same version one gets ``Conflict``. A reader takes the newest complete
pointer: what a lost driver left behind, folders or half a pointer, is never read.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published a version in between."""


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = filesystem(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = filesystem(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, base: str) -> list[str]:
    """Names of what lies directly under ``base``, ascending; nothing if it is absent."""
    fs, p, _ = filesystem(spark, base)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def finished_folders(spark: SparkSession, base: str, prefix: str, marker: str = "_SUCCESS") -> list[str]:
    """Names of the finished folders under ``base``, ascending."""
    return [n for n in names(spark, base) if n.startswith(prefix) and exists(spark, os.path.join(base, n, marker))]


def fresh_name() -> str:
    """Sorts by time and never repeats."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def partition_path(spark: SparkSession, **values: str) -> str:
    """The folder that Spark's partitioned writes give these values."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return os.path.join(*[f"{k}={escape(v)}" for k, v in values.items()])


def _pointers(base: str) -> str:
    return os.path.join(base, "_pointers")


def read_pointer(spark: SparkSession, base: str) -> tuple[int, dict]:
    """Number and content of the newest complete pointer of ``base``; (0, {}) without one."""
    for name in reversed(names(spark, _pointers(base))):
        fs, p, jvm = filesystem(spark, os.path.join(_pointers(base), name))
        stream = fs.open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text.endswith("\n"):   # the last character written
            return int(name), json.loads(text)
    return 0, {}


def write_pointer(spark: SparkSession, base: str, after: int, content: dict, keep: int = 4) -> int:
    """Publish ``content`` as the version after number ``after``; raises ``Conflict`` if there is a newer one already."""
    taken = [int(n) for n in names(spark, _pointers(base))]
    if read_pointer(spark, base)[0] != after:
        raise Conflict(f"{base}: version {after} is no longer the newest")
    number = max([after, *taken]) + 1
    fs, p, jvm = filesystem(spark, os.path.join(_pointers(base), f"{number:012d}"))
    try:
        stream = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - the file system's own kind of "exists already"
        raise Conflict(f"{base}: version {number} was written by another run") from e
    try:
        stream.write(bytearray((json.dumps(content) + "\n").encode()))
    finally:
        stream.close()
    for old in sorted(taken)[:-keep]:
        delete(spark, os.path.join(_pointers(base), f"{old:012d}"))
    return number
