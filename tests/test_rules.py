"""One hand-written row per rule of every rule set, through the whole silver build."""

import pytest
from pyspark.sql import functions as F

from stratamart.operators.rules import RULES
from stratamart.plans import silver
from stratamart.schemas import bronze_schema
from stratamart.sources.raw import stamp

DAY = "2018-01-{:02d} 00:00:00"
ORDER = {
    "order_id": "o", "customer_id": "c", "order_status": "delivered",
    "order_purchase_timestamp": DAY.format(10), "order_approved_at": DAY.format(11),
    "order_delivered_carrier_date": DAY.format(12), "order_delivered_customer_date": DAY.format(13),
    "order_estimated_delivery_date": DAY.format(14),
}
ITEM = {
    "order_id": "o", "order_item_id": "1", "product_id": "p", "seller_id": "s",
    "shipping_limit_date": DAY.format(1), "price": "1.50", "freight_value": "0.10",
}
PAYMENT = {
    "order_id": "o", "payment_sequential": "1", "payment_type": "CARD", "payment_installments": "2",
    "payment_value": "9.90",
}
CUSTOMER = {
    "customer_id": "c", "customer_unique_id": "u", "customer_zip_code_prefix": "01234",
    "customer_city": "CITY", "customer_state": "sp",
}
SELLER = {"seller_id": "s", "seller_zip_code_prefix": "01234", "seller_city": "CITY", "seller_state": "sp"}
PRODUCT = {
    "product_id": "p", "product_category_name": "toys", "product_name_lenght": "1",
    "product_description_lenght": "2", "product_photos_qty": "3", "product_weight_g": "4.5",
    "product_length_cm": "5", "product_height_cm": "6", "product_width_cm": "7",
}
MEASURES = {
    "product_name_lenght": "product_name_length", "product_description_lenght": "product_description_length",
    "product_photos_qty": "product_photos_qty", "product_weight_g": "product_weight_g",
    "product_length_cm": "product_length_cm", "product_height_cm": "product_height_cm",
    "product_width_cm": "product_width_cm",
}

CASES = {
    "orders": (ORDER, "order_id", [
        ({}, "VALID", None),
        ({"order_purchase_timestamp": "x"}, "CHECK", "Missing or invalid purchase timestamp"),
        ({"order_status": " "}, "CHECK", "Missing order status"),
        ({"order_approved_at": DAY.format(9)}, "CHECK", "Approved before purchase"),
        ({"order_delivered_carrier_date": DAY.format(9)}, "CHECK", "Carrier delivery before purchase"),
        ({"order_delivered_customer_date": DAY.format(9)}, "CHECK", "Customer delivery before purchase"),
        ({"order_delivered_customer_date": DAY.format(11)}, "CHECK", "Customer delivery before carrier"),
        ({"order_estimated_delivery_date": DAY.format(9)}, "CHECK", "Estimated delivery before purchase"),
        ({"order_purchase_timestamp": "", "order_status": ""}, "CHECK", "Missing or invalid purchase timestamp"),
        ({"customer_id": "", "order_approved_at": "", "order_delivered_carrier_date": "",
          "order_delivered_customer_date": "", "order_estimated_delivery_date": ""}, "VALID", None),
        ({"order_id": '""'}, "REJECTED", "Missing order_id"),
    ]),
    "order_items": (ITEM, "order_id", [
        ({}, "VALID", None),
        ({"order_item_id": "x"}, "REJECTED", "Missing or invalid order_item_id"),
        ({"order_item_id": "0"}, "REJECTED", "Invalid order_item_id"),
        ({"product_id": ""}, "REJECTED", "Missing product_id"),
        ({"seller_id": None}, "REJECTED", "Missing seller_id"),
        ({"price": "n/a"}, "CHECK", "Missing or invalid price"),
        ({"price": "-1"}, "CHECK", "Negative price"),
        ({"freight_value": ""}, "CHECK", "Missing or invalid freight_value"),
        ({"freight_value": "-0.01"}, "CHECK", "Negative freight_value"),
        ({"shipping_limit_date": "soon"}, "CHECK", "Missing or invalid shipping_limit_date"),
        ({"order_id": " "}, "REJECTED", "Missing order_id"),
    ]),
    "order_payments": (PAYMENT, "order_id", [
        ({}, "VALID", None),
        ({"payment_sequential": "x"}, "REJECTED", "Missing or invalid payment_sequential"),
        ({"payment_sequential": "-1"}, "REJECTED", "Invalid payment_sequential"),
        ({"payment_type": ""}, "CHECK", "Missing payment_type"),
        ({"payment_installments": "2.5"}, "CHECK", "Invalid payment_installments"),
        ({"payment_installments": "-2"}, "CHECK", "Negative payment_installments"),
        ({"payment_value": "abc"}, "CHECK", "Invalid payment_value"),
        ({"payment_value": "-5"}, "CHECK", "Negative payment_value"),
        ({"payment_installments": "", "payment_value": None}, "VALID", None),
        ({"order_id": ""}, "REJECTED", "Missing order_id"),
    ]),
    "customers": (CUSTOMER, "customer_id", [
        ({}, "VALID", None),
        ({"customer_unique_id": '" "'}, "REJECTED", "Missing customer_unique_id"),
        ({"customer_zip_code_prefix": "1A"}, "CHECK", "Invalid customer_zip_code_prefix"),
        ({"customer_zip_code_prefix": ""}, "VALID", None),
        ({"customer_city": ""}, "CHECK", "Missing customer_city"),
        ({"customer_state": ""}, "CHECK", "Missing customer_state"),
        ({"customer_id": ""}, "REJECTED", "Missing customer_id"),
    ]),
    "sellers": (SELLER, "seller_id", [
        ({}, "VALID", None),
        ({"seller_zip_code_prefix": "123456"}, "CHECK", "Invalid seller_zip_code_prefix"),
        ({"seller_city": ""}, "CHECK", "Missing seller_city"),
        ({"seller_state": ""}, "CHECK", "Missing seller_state"),
        ({"seller_state": "spx"}, "CHECK", "Invalid seller_state_code"),
        ({"seller_state": 'rio, brasil",RJ'}, "VALID", None),
        ({"seller_id": ""}, "REJECTED", "Missing seller_id"),
    ]),
    "products": (PRODUCT, "product_id", [
        ({}, "VALID", None),
        ({"product_category_name": ""}, "CHECK", "Missing product category"),
        *[({raw: "abc"}, "CHECK", f"Invalid {name}") for raw, name in MEASURES.items()],
        *[({raw: "-1"}, "CHECK", f"Negative {name}") for raw, name in MEASURES.items()],
        *[({raw: ""}, "VALID", None) for raw in MEASURES],
        ({"product_name_lenght": "-1", "product_width_cm": "?"}, "CHECK", "Invalid product_width_cm"),
        ({"product_id": ""}, "REJECTED", "Missing product_id"),
    ]),
}


@pytest.mark.parametrize("table", CASES)
def test_every_rule(spark, table):
    base, key, cases = CASES[table]
    rows = []
    for number, (change, _, _) in enumerate(cases):
        row = {**base, key: f"k{number:02d}", **change}
        rows.append(tuple(row[c] for c in base))
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in base))
    bronze = stamp(raw, 1, F.lit("2024-01-01"), "f.csv").select(*bronze_schema(table).fieldNames())
    judged = silver.build(bronze, table).select(key, "data_quality_status", "data_quality_reason").collect()
    found = {r[0]: (r[1], r[2]) for r in judged}
    expected = {
        (None if key in change else f"k{n:02d}"): (status, reason) for n, (change, status, reason) in enumerate(cases)
    }
    assert found == expected
    wanted = {reason for _, _, reason in RULES[table]()}
    assert wanted == {reason for _, _, reason in cases if reason}, "a rule has no case"


def test_delivery_rules(spark):
    _, _, cases = CASES["orders"]
    rows = [tuple({**ORDER, "order_id": f"k{n:02d}", **change}[c] for c in ORDER) for n, (change, _, _) in enumerate(cases)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ORDER))
    bronze = stamp(raw, 1, F.lit("2024-01-01"), "f.csv")
    orders = silver.accepted(silver.build(bronze, "orders"))
    found = {r.order_id: (r.data_quality_status, r.data_quality_reason) for r in silver.build_delivery(orders).collect()}
    assert found["k00"] == ("VALID", None)
    assert found["k01"] == ("CHECK", "Missing purchase timestamp")
    assert found["k02"] == ("VALID", None)
    assert found["k03"] == ("VALID", None)
    assert [found[f"k{n:02d}"][1] for n in (4, 5, 6, 7)] == [
        "Carrier delivery before purchase", "Customer delivery before purchase", "Customer delivery before carrier",
        "Estimated delivery before purchase",
    ]
    unkeyed = orders.limit(1).withColumn("order_id", F.lit(None).cast("string"))
    assert silver.build_delivery(unkeyed).first().data_quality_reason == "Missing order_id"
