"""Folders of the session's file system, wherever that is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)
