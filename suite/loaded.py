"""One warehouse per session and data folder, loaded through the package's own jobs."""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratamart.plans.warehouse import Warehouse, side_by_side
from stratamart.session import new_folder
from suite import fixtures

_loaded: dict[tuple[str, str], Warehouse] = {}


def load_time(load: int) -> datetime:
    return datetime(2024, 1, 1) + timedelta(days=load)


def deliver(warehouse: Warehouse, sf_dir: str, name: str) -> dict:
    """Load every delivery of one bronze table, in load order."""
    rows = fixtures.bronze(warehouse.spark, sf_dir, name)
    loads = fixtures.LOADS.get(name, 1)
    result = {}
    for load in range(1, loads + 1):
        part = rows.where(F.col("load_id") == load)
        when = load_time(load if loads > 1 else 1)
        result = warehouse.load_bronze_rows(name, part, f"{name}_{load}", f"{name}_{load}.csv", when)
    return result


def empty_warehouse(spark: SparkSession) -> Warehouse:
    """A new warehouse."""
    return Warehouse(spark, new_folder(spark, "warehouse"))


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this session over the given tables; built on first use."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _loaded:
        warehouse = empty_warehouse(spark)
        side_by_side({name: partial(deliver, warehouse, sf_dir, name) for name in fixtures.INPUTS})
        warehouse.refresh()
        _loaded[key] = warehouse
    return _loaded[key]
