"""Rows above a watermark, and the probe that says whether there are any."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_rows(df: DataFrame, watermark: int, load_column: str = "load_id") -> DataFrame:
    """Rows of loads after the watermark; prunes partitions when the table is laid out by load."""
    return df.where(F.col(load_column) > watermark)


def rows_of_loads(df: DataFrame, loads: Iterable[int], load_column: str = "load_id") -> DataFrame:
    """Rows of the named loads; unlike a watermark it still finds a load that came late."""
    return df.where(F.col(load_column).isin(sorted(loads)))


def probe(df: DataFrame, load_column: str = "load_id") -> DataFrame:
    """Highest load and row count of an increment in one pass."""
    return df.agg(
        F.max(load_column).alias("max_load_id"),
        F.count(F.lit(1)).alias("rows_extracted"),
    )


def watermark_value(text: str | None) -> int:
    """Stored watermark text as a number; missing or unreadable text counts as 0."""
    try:
        return int(text)
    except (TypeError, ValueError):
        return 0
