"""Folders of stored tables, on whatever file system the path names: listing, and deleting what is superseded."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist. Names alone: no file is opened."""
    fs, at = _system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _system(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _system(spark, path)
    fs.delete(at, True)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that writes this folder has committed."""
    return exists(spark, f"{path}/_SUCCESS")
