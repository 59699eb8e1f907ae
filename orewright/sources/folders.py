"""Folders of the shared file system, reached the way Spark's own readers reach them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, sorted; nothing if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder ended well: Spark leaves a mark when it commits."""
    fs, where = _at(spark, f"{path}/_SUCCESS")
    return fs.exists(where)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step; one that is there stays."""
    fs, where = _at(spark, path)
    fs.createNewFile(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def signature(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and last change of a file or folder: another one when what it holds was changed."""
    fs, where = _at(spark, path)
    held = fs.getContentSummary(where)
    return held.getLength(), held.getFileCount(), fs.getFileStatus(where).getModificationTime()
