"""Small file-system helpers over the Hadoop API, so they work wherever Spark reads."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def child_ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Hours since each child was last changed."""
    fs, at = _open(spark, path)
    found = fs.listStatus(at) if fs.exists(at) else []
    return {s.getPath().getName(): time.time() / 3600 - s.getModificationTime() / 3_600_000 for s in found}


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _open(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file whole or not at all; an existing one means another writer won.

    Rests on a rename that does not replace, as HDFS has; where the store
    copies instead, let one writer at a time run.
    """
    fs, at = _open(spark, path)
    partial = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(partial, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(at) or not fs.rename(partial, at):
        fs.delete(partial, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.delete(at, True)
