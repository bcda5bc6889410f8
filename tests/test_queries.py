"""Every registered query against its SQL in DuckDB, and the shape of the main plans."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from suite.compare import difference, duck
from suite.loaded import loaded_warehouse
from suite.queries import QUERIES as SUITE


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    from suite.oracle import ORACLE
    from suite.queries import QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", SUITE)
def test_query(spark, connection, sf_dir, name):
    assert difference(spark, connection, queries()[name], oracle_sql()[name], sf_dir) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_prunes_folders_and_columns(spark, sf_dir):
    text = plan(queries()["sales_trend_filtered"](spark, sf_dir))
    assert "order_month" in text and "PartitionFilters: [isnotnull(order_month" in text
    fact_scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "order_month#" in line)
    schema = fact_scan[fact_scan.index("ReadSchema") :]
    assert "freight_value" not in schema and "order_id" not in schema


def test_fact_check_reads_one_column(spark, sf_dir):
    gold = loaded_warehouse(spark, sf_dir).gold_tables()
    from stratamart.operators.checks import check_fk

    text = plan(check_fk("x", gold["fact_sales"], "seller_key", gold["dim_seller"], "seller_key"))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 2 and all("ReadSchema: struct<seller_key:bigint>" in scan for scan in scans)


def test_no_python_and_no_cross_join_in_any_plan(spark, sf_dir):
    for name in ("silver_products", "upsert_orders", "fact_sales", "customers_by_state", "kpi_overview", "val_fk"):
        text = plan(queries()[name](spark, sf_dir))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)


def test_complete_facts_join_inner(spark, sf_dir):
    assert "LeftOuter" not in plan(queries()["fact_sales"](spark, sf_dir))


def test_merge_takes_one_shuffle(spark, sf_dir):
    from stratamart.operators.upsert import upsert

    stored = loaded_warehouse(spark, sf_dir).silver("orders")
    merged = upsert(stored, stored, ["order_id"], newer="source_load_id")
    assert plan(merged).count("Exchange hashpartitioning") == 1
