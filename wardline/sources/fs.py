"""Paths on whatever file system Spark resolves (local, HDFS, object stores)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file, replacing one that is there."""
    p, fs = _open(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless there is one; whether it was written."""
    p, fs = _open(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # the file system's own "already exists"
        if fs.exists(p):
            return False
        raise e
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small text file."""
    p, fs = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def listing(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, time of its last change in epoch seconds) of what a folder holds; empty without the folder."""
    p, fs = _open(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    p, fs = _open(spark, path)
    fs.delete(p, True)
