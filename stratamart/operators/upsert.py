"""Keyed upsert and insert-if-absent over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEPT, UPDATED, INSERTED, STALE = "kept", "updated", "inserted", "stale"
CHANGE = "change_type"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer: str | None = None,
    carry: str | None = None,
) -> DataFrame:
    """Target after the upsert, each row marked kept, updated or inserted.

    Keys are unique on either side. With ``newer`` a matched row is replaced only when the
    source holds a strictly greater value in that column; without it the source always wins.
    ``carry`` names a target-only column (a surrogate key) that survives the replacement.

    Both sides are stacked and the winner is picked per key, so the merge needs one shuffle. At
    most two rows share a key, so no group can grow hot.
    """
    if carry:
        source = source.withColumn(carry, F.lit(None).cast(target.schema[carry].dataType))
    stacked = target.withColumn("_incoming", F.lit(0)).unionByName(source.withColumn("_incoming", F.lit(1)))
    everyone = Window.partitionBy(*keys)
    if newer:
        ranked = everyone.orderBy(F.col(newer).desc_nulls_last(), F.col("_incoming").asc())
    else:
        ranked = everyone.orderBy(F.col("_incoming").desc())
    wide = stacked.withColumns(
        {
            "_rank": F.row_number().over(ranked),
            "_versions": F.count(F.lit(1)).over(everyone),
        }
    )
    if carry:
        wide = wide.withColumn(carry, F.max(carry).over(everyone))
    change = (
        F.when(F.col("_incoming") == 0, KEPT).when(F.col("_versions") > 1, UPDATED).otherwise(INSERTED)
    )
    winners = wide.where(F.col("_rank") == 1).withColumn(CHANGE, change)
    return winners.drop("_rank", "_versions", "_incoming")


def changes(held: DataFrame, source: DataFrame, keys: Sequence[str], newer: str) -> DataFrame:
    """Source rows with what an upsert would make of them: inserted, updated, or stale, which changes nothing.

    ``held`` has the keys and the ``newer`` column of the table's rows; a key may stand in several
    of its versions. Only these columns are moved, and the rows of the table are not rewritten.
    """
    last = held.groupBy(*keys).agg(F.max(newer).alias("_held"))
    marked = source.join(last, list(keys), "left")
    change = F.when(F.col("_held").isNull(), INSERTED).when(F.col(newer) > F.col("_held"), UPDATED).otherwise(STALE)
    return marked.withColumn(CHANGE, change).drop("_held")


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not hold."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def change_counts(merged: DataFrame) -> DataFrame:
    """rows_updated, rows_inserted and their sum, in one pass over the marked result."""
    updated = F.count_if(F.col(CHANGE) == UPDATED)
    inserted = F.count_if(F.col(CHANGE) == INSERTED)
    return merged.agg(
        updated.alias("rows_updated"),
        inserted.alias("rows_inserted"),
        (updated + inserted).alias("rows_loaded"),
    )
