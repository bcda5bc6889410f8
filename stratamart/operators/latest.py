"""Keep the newest version of every key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(ties: Iterable[str]) -> list[Column]:
    """Load order, newest first; the tie columns make the choice repeatable within one file."""
    return [F.col("load_datetime").desc_nulls_last(), F.col("load_id").desc_nulls_last()] + [
        F.col(name).asc_nulls_last() for name in ties
    ]


def latest(df: DataFrame, keys: Iterable[str], order: Iterable[Column]) -> DataFrame:
    """First row of each key in the given order; rows with NULL keys share one group.

    Written as ``row_number() = 1`` so that Spark adds a window group limit *below* the
    shuffle: each map task sends at most one row per key, and a key that holds a third of
    the input arrives as one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")
