"""What Spark's file systems know and DataFrames do not: which paths there are, and removing folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern; none if there is no such folder."""
    path, files = _path(spark, pattern)
    return [f.getPath().toString() for f in files.globStatus(path) or []]


def remove(spark: SparkSession, folders: Iterable[str]) -> None:
    for folder in folders:
        path, files = _path(spark, folder)
        files.delete(path, True)
