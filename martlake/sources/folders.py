"""Folders on the storage that Spark writes to; Spark has no call of its own to list or remove them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    files, path = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def remove(spark: SparkSession, path: str) -> bool:
    """Removes a folder with all it holds; false where there was none."""
    files, path = _hadoop(spark, path)
    return files.delete(path, True)
