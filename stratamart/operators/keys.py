"""Dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOT_DIGITS = 3
#: A million slots, of some 30 bytes each, are the most whose sizes are broadcast.
MOST_DIGITS = 5


def key_slot(keys: Sequence[str], digits: int = SLOT_DIGITS) -> Column:
    """Leading hex digits of the key's digest: an even spread over 16^digits slots whatever the keys look like."""
    return F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])), 1, digits)


def assign_keys(
    new: DataFrame, key_column: str, keys: Sequence[str], offset: int, kind: str = "bigint", digits: int = SLOT_DIGITS
) -> DataFrame:
    """Number the new members offset+1, offset+2, ... by (slot, business key).

    Rows are numbered inside their slot and shifted by the sizes of the slots before it. The
    slot sizes are at most 16^digits rows, so running them up in one window and broadcasting them
    is safe at any data size; the rows themselves take one even shuffle over as many groups. More
    digits suit larger loads: four make 65,536 slots. The input is read twice, so it should be a
    stored table. The numbering depends on the keys and digits alone, so a recomputed task gives the
    same numbers.
    """
    if not 1 <= digits <= MOST_DIGITS:
        raise ValueError(f"1 to {MOST_DIGITS} digits, not {digits}: the sizes of 16^digits slots are broadcast")
    slotted = new.withColumn("_slot", key_slot(keys, digits))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slotted.groupBy("_slot").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_slot").orderBy(*keys))
    numbered = slotted.withColumn("_inside", inside).join(F.broadcast(starts), "_slot")
    key = (F.lit(offset) + F.col("_start") + F.col("_inside")).cast(kind)
    return numbered.withColumn(key_column, key).drop("_slot", "_inside", "_start")
