"""What lies in a folder of the store, asked through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; a folder that isn't there has none."""
    store, path = _store(spark, folder)
    return [x.getPath().getName() for x in store.listStatus(path)] if store.exists(path) else []


def has_rows(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder was committed: only then are there part files in it."""
    return any(name.startswith("part-") for name in children(spark, folder))


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that a load wrote for itself alone and has read to the end."""
    store, path = _store(spark, folder)
    store.delete(path, True)
