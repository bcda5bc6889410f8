"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTE = '"'


def clean(value: Column | str, case: str | None = None) -> Column:
    """Drop double quotes, trim blanks, turn empty into NULL; optionally fold the case."""
    col = F.col(value) if isinstance(value, str) else value
    bare = F.trim(F.replace(col, F.lit(QUOTE), F.lit("")))
    text = F.nullif(bare, F.lit(""))
    if case == "upper":
        return F.upper(text)
    if case == "lower":
        return F.lower(text)
    return text


def state_code(value: Column) -> Column:
    """Last two characters of a state that carries other place names before a comma."""
    return F.when(F.contains(value, F.lit(",")), F.right(F.trim(value), F.lit(2))).otherwise(value)


def bad_zip(value: Column) -> Column:
    """True for a present ZIP prefix that is not exactly five digits."""
    return value.isNotNull() & ((F.length(value) != 5) | value.rlike("[^0-9]"))
