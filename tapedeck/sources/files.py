"""Questions to the file system of a path, whatever store it is in."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _at(spark, path)
    return store.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under a folder, sorted; none for a missing folder."""
    store, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def mark(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file; an error if it is there, so that only one of two writers gets on."""
    store, where = _at(spark, path)
    if not store.createNewFile(where):
        raise FileExistsError(path)
    if text:
        out = store.create(where, True)
        out.write(bytearray(text.encode()))
        out.close()


def marked(spark: SparkSession, path: str) -> str:
    """The text of a small file; empty while its writer has not come that far."""
    store, where = _at(spark, path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(store.open(where)))
    text = reader.readLine()
    reader.close()
    return text or ""


def hours_old(spark: SparkSession, path: str) -> float:
    store, where = _at(spark, path)
    return (time.time() * 1000 - store.getFileStatus(where).getModificationTime()) / 3_600_000 if store.exists(where) else 0.0


def remove(spark: SparkSession, path: str) -> None:
    store, where = _at(spark, path)
    store.delete(where, True)


def stored_size(spark: SparkSession, path: str) -> int:
    """Bytes under a folder."""
    store, where = _at(spark, path)
    return store.getContentSummary(where).getLength() if store.exists(where) else 0
