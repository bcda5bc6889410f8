"""Date keys and delivery measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(value: Column) -> Column:
    """yyyymmdd as an integer, NULL for NULL."""
    return F.year(value) * 10000 + F.month(value) * 100 + F.day(value)


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from start to end."""
    return F.datediff(end, start)


def delivery_status(delivered: Column, estimated: Column) -> Column:
    delay = days_between(estimated, delivered)
    return (
        F.when(delivered.isNull(), "Not Delivered")
        .when(estimated.isNull(), "Delivered - No Estimate")
        .when(delay > 0, "Late")
        .when(delay == 0, "On Time")
        .otherwise("Early")
    )
