"""The SQL side against numbers that were computed once, before any of this code existed."""

import pytest

from suite.compare import duck
from suite.oracle import sql

# Expected results over the sf0.01 tables.
STATUS = {
    "orders": {"VALID": 14634, "CHECK": 350, "REJECTED": 1},
    "order_items": {"VALID": 43718, "CHECK": 1854, "REJECTED": 375},
    "order_payments": {"VALID": 18160, "CHECK": 547, "REJECTED": 34},
    "customers": {"VALID": 1420, "CHECK": 77, "REJECTED": 3},
    "sellers": {"VALID": 87, "CHECK": 13},
    "products": {"VALID": 1854, "CHECK": 146},
    "delivery": {"VALID": 14830, "CHECK": 154},
}
ROWS = {
    "silver_orders": 14984, "silver_order_items": 45572, "silver_order_payments": 18707, "dim_customer": 1349,
    "dim_product": 2000, "fact_sales": 45228, "fact_payments": 18569, "fact_delivery": 14958,
}
DELIVERY = {
    "Delivered - No Estimate": (802, 10778, None),
    "Early": (6411, 54063, -35468),
    "Late": (5770, 108889, 29035),
    "Not Delivered": (1362, None, None),
    "On Time": (639, 8890, 0),
}


@pytest.fixture(scope="module")
def connection():
    return duck("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", STATUS)
def test_status_counts(connection, name):
    text = sql(f"SELECT data_quality_status, count(*) FROM judged_{name} GROUP BY 1")
    assert dict(connection.execute(text).fetchall()) == STATUS[name]


def test_stored_rows(connection):
    for name, rows in ROWS.items():
        assert connection.execute(sql(f"SELECT count(*) FROM {name}")).fetchone()[0] == rows, name


def test_delivery_measures(connection):
    text = sql(
        "SELECT delivery_status, count(*), sum(delivery_days), sum(delivery_delay_days) FROM silver_delivery GROUP BY 1"
    )
    assert {r[0]: tuple(r[1:]) for r in connection.execute(text).fetchall()} == DELIVERY
