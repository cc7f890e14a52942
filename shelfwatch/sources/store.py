"""Small marker files on the file system Spark uses (local, HDFS or object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    found = fs.globStatus(where)
    return bool(found)


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path parts of what matches a glob."""
    fs, where = _fs(spark, pattern)
    return sorted(s.getPath().getName() for s in (fs.globStatus(where) or []))


def paths(spark: SparkSession, pattern: str) -> list[str]:
    fs, where = _fs(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(where) or []))


def put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; an existing one is an error.

    A reader may see it while it is written: texts must end in a way that tells.
    """
    fs, where = _fs(spark, path)
    out = fs.create(where, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def get(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
