"""Folders of versioned tables, on any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def found(spark: SparkSession, base: str, pattern: str) -> list[str]:
    """Paths below ``base`` that match a glob pattern, without ``base``."""
    fs, path = _file_system(spark, f"{base}/{pattern}")
    start = len(_path(spark, base).toUri().getPath())
    return [x.getPath().toUri().getPath()[start:] for x in fs.globStatus(path) or []]


def delete(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def values(path: str) -> dict[str, str]:
    """The ``name=value`` parts of a path."""
    return dict(x.split("=", 1) for x in path.split("/") if "=" in x)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    path = _path(spark, path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
