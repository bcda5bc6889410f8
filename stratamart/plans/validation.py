"""Validation of a loaded warehouse: counts, control totals, integrity, grain, quality summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators import checks
from stratamart.schemas import GOLD, SILVER, TOTAL, TOTALS

Tables = Mapping[str, DataFrame]

# The labels of the reports.
_GOLD_LABELS = {
    "DimCustomer": "dim_customer",
    "DimProduct": "dim_product",
    "DimSeller": "dim_seller",
    "DimDate": "dim_date",
    "FactSales": "fact_sales",
    "FactPayments": "fact_payments",
    "FactDelivery": "fact_delivery",
}
_SILVER_LABELS = {
    "Orders": "orders",
    "Order Items": "order_items",
    "Products": "products",
    "Customers": "customers",
    "Sellers": "sellers",
    "Payments": "order_payments",
    "Delivery": "delivery",
}
#: Declared lengths of the text columns of gold.
DECLARED_LENGTHS = {
    "dim_date": {"month_name": 20, "day_name": 20},
    "dim_customer": {
        "customer_unique_id": 50, "customer_id": 50, "customer_zip_code_prefix": 5, "customer_city": 100,
        "customer_state": 2,
    },
    "dim_product": {"product_id": 50, "product_category_name": 255, "product_category_name_english": 255},
    "dim_seller": {"seller_id": 50, "seller_zip_code_prefix": 5, "seller_city": 100, "seller_state": 2},
    "fact_sales": {"order_id": 50},
    "fact_payments": {"order_id": 50, "payment_type": 50},
    "fact_delivery": {"order_id": 50, "delivery_status": 30},
}


def row_counts(gold: Tables) -> DataFrame:
    return checks.check_rows({label: gold[name] for label, name in _GOLD_LABELS.items()})


def control_totals(silver: Tables, gold: Tables) -> DataFrame:
    """Item and payment sums, silver against gold."""
    sales = {"total_price": "price", "total_freight": "freight_value"}
    payments = {"total_price": "payment_value", "total_freight": None}
    return checks.check_totals(
        {
            "Silver Order Items": silver["order_items"],
            "Gold FactSales": gold["fact_sales"],
            "Silver Payments": silver["order_payments"],
            "Gold FactPayments": gold["fact_payments"],
        },
        {
            "Silver Order Items": sales,
            "Gold FactSales": sales,
            "Silver Payments": payments,
            "Gold FactPayments": payments,
        },
        "decimal(38,2)",
    )


def delivery_totals(silver: Tables, gold: Tables) -> DataFrame:
    sums = {"total_delivery_days": "delivery_days", "total_delay_days": "delivery_delay_days"}
    return checks.check_totals(
        {"Silver Delivery": silver["delivery"], "Gold FactDelivery": gold["fact_delivery"]},
        {"Silver Delivery": sums, "Gold FactDelivery": sums},
        "bigint",
    )


# The labels of the links, mandatory and optional.
_LINKS = {
    "fact_sales": [
        ("FactSales - Customer", "customer_key", "dim_customer"),
        ("FactSales - Product", "product_key", "dim_product"),
        ("FactSales - Seller", "seller_key", "dim_seller"),
        ("FactSales - Date", "order_date_key", "dim_date"),
    ],
    "fact_payments": [
        ("FactPayments - Customer", "customer_key", "dim_customer"),
        ("FactPayments - Date", "order_date_key", "dim_date"),
    ],
    "fact_delivery": [("FactDelivery - Customer", "customer_key", "dim_customer")],
}
_DATE_ROLES = [
    ("FactDelivery - Purchase Date", "purchase_date_key"),
    ("FactDelivery - Delivered Date", "delivered_date_key"),
    ("FactDelivery - Carrier Date", "carrier_date_key"),
    ("FactDelivery - Estimated Date", "estimated_delivery_date_key"),
]


def _member_keys(gold: Tables, names) -> dict:
    return {name: (gold[name], GOLD[name].surrogate or GOLD[name].keys[0]) for name in names}


def foreign_keys(gold: Tables) -> DataFrame:
    """The mandatory links; every count should be 0."""
    facts = [(gold[name], [(*link, False) for link in links]) for name, links in _LINKS.items()]
    return checks.check_links(facts, _member_keys(gold, ("dim_customer", "dim_product", "dim_seller", "dim_date")))


def delivery_dates(gold: Tables) -> DataFrame:
    """The optional date links of deliveries; only present keys are tested."""
    links = [(label, column, "dim_date", True) for label, column in _DATE_ROLES]
    return checks.check_links([(gold["fact_delivery"], links)], _member_keys(gold, ("dim_date",)))


def fact_grain(gold: Tables) -> DataFrame:
    facts = {"FactSales": "fact_sales", "FactPayments": "fact_payments", "FactDelivery": "fact_delivery"}
    return checks.stack([checks.check_grain(label, gold[name], GOLD[name].keys) for label, name in facts.items()])


def dimension_uniqueness(gold: Tables) -> DataFrame:
    dims = {"DimCustomer": "dim_customer", "DimProduct": "dim_product", "DimSeller": "dim_seller"}
    return checks.stack([checks.check_unique(label, gold[name], GOLD[name].keys[0]) for label, name in dims.items()])


def quality_summary(silver: Tables) -> DataFrame:
    return checks.status_counts({label: silver[name] for label, name in _SILVER_LABELS.items()})


def unique_contracts(silver: Tables, gold: Tables) -> DataFrame:
    """Primary keys of both layers and the business keys of gold; every count should be 0."""
    tested = [checks.duplicate_keys(f"silver.{n}", silver[n], t.keys) for n, t in SILVER.items()]
    for name, spec in GOLD.items():
        tested.append(checks.duplicate_keys(f"gold.{name}", gold[name], spec.keys))
        if spec.surrogate:
            tested.append(checks.duplicate_keys(f"gold.{name}.{spec.surrogate}", gold[name], [spec.surrogate]))
    return checks.stack(tested)


def not_null_contracts(silver: Tables, gold: Tables) -> DataFrame:
    """Columns declared NOT NULL, one scan per table; every count should be 0."""
    lineage = ["data_quality_status", "source_load_id", "source_load_datetime", "source_file"]
    extra = {"customers": ["customer_unique_id"], "delivery": ["delivery_status"]}
    tested = [
        checks.check_not_null(f"silver.{name}", silver[name], [*t.keys, *extra.get(name, []), *lineage])
        for name, t in SILVER.items()
    ]
    tested += [checks.check_not_null(f"gold.{name}", gold[name], spec.required) for name, spec in GOLD.items()]
    return checks.stack(tested)


def length_contracts(gold: Tables) -> DataFrame:
    """Values longer than declared; they are kept and reported, never cut."""
    return checks.stack(
        [checks.check_length(f"gold.{name}", gold[name], limits) for name, limits in DECLARED_LENGTHS.items()]
    )


def state_audit(state: DataFrame, silver: Tables, gold: Tables) -> DataFrame:
    """The totals that the commits carry beside those of a full scan; they must agree.

    ``state`` has table_name, status, measure and state_value, as the warehouse's own ``state`` gives it.
    """
    scanned = []
    for name, columns in TOTALS.items():
        layer, status = (silver, F.col("data_quality_status")) if name in SILVER else (gold, F.lit(""))
        sums = [F.sum(c).cast(TOTAL).alias(c) for c in columns]
        totals = layer[name].groupBy(status.alias("status")).agg(F.count(F.lit(1)).cast(TOTAL).alias("rows"), *sums)
        pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("scan_value")) for c in ("rows", *columns)])
        scanned.append(totals.select(F.lit(name).alias("table_name"), "status", F.explode(pairs).alias("_pair")).select("table_name", "status", "_pair.*"))
    return state.join(checks.stack(scanned), ["table_name", "status", "measure"], "full")
