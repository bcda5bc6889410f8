"""Stored tables as plain Parquet folders.

A load writes a new ``version=N`` folder and publishes it through one commit record, so a
table is never overwritten while it is read and a failed job leaves the last state in place.
A version holds the changes of its load or, where its commit says so, all current rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from stratamart.sources.ledger import no_rows

#: How all tables are written.
PACKED = {"compression": "zstd"}


def published(commits: list[Row]) -> list[Row]:
    """Commits that brought a version, oldest first."""
    return [c for c in commits if c.version is not None]


def current(commits: list[Row]) -> list[Row]:
    """Versions that hold the current rows: the last whole one and all after it."""
    versions = published(commits)
    whole = [i for i, c in enumerate(versions) if c.whole]
    return versions[whole[-1] :] if whole else versions


def folders(root: str, versions: list[Row]) -> list[str]:
    return [f"{root}/version={c.version}" for c in versions]


def read_folders(spark: SparkSession, root: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """The rows below the given folders; no folder means an empty table."""
    if not paths:
        return no_rows(spark, schema)
    layout = T.StructType(schema.fields + [T.StructField("version", T.LongType())])
    return spark.read.schema(layout).option("basePath", root).parquet(*paths).select(*schema.fieldNames())
