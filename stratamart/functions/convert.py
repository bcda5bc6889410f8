"""Text to typed values; anything that does not read cleanly becomes NULL.

The patterns keep out forms that Spark's cast takes but a strict conversion does not
(``1e3`` as a decimal, ``2017`` as a timestamp). ``\\z`` rather than ``$``, so that a
trailing carriage return does not slip through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
INT_FORM = r"^[+-]?[0-9]+\z"
DECIMAL_FORM = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\z"
TIMESTAMP_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,7})?)?)?\z"


def _guarded(value: Column, form: str, target: str) -> Column:
    return F.when(value.rlike(form), value.try_cast(target))


def to_int(value: Column) -> Column:
    return _guarded(value, INT_FORM, "int")


def to_decimal(value: Column) -> Column:
    return _guarded(value, DECIMAL_FORM, "decimal(18,2)")


def to_timestamp_ntz(value: Column) -> Column:
    return _guarded(value, TIMESTAMP_FORM, "timestamp_ntz")
