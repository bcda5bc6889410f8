"""Ordered data-quality rules: the first rule that holds sets both status and reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.text import bad_zip

VALID, CHECK, REJECTED = "VALID", "CHECK", "REJECTED"
Rule = tuple[Column, str, str]


def classify(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add data_quality_status and data_quality_reason; no rule means VALID without a reason."""
    verdict = None
    for holds, status, reason in rules:
        outcome = F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))
        verdict = F.when(holds, outcome) if verdict is None else verdict.when(holds, outcome)
    verdict = verdict.otherwise(
        F.struct(F.lit(VALID).alias("status"), F.lit(None).cast("string").alias("reason"))
    )
    judged = df.withColumn("_verdict", verdict)
    return judged.withColumns(
        {
            "data_quality_status": F.col("_verdict.status"),
            "data_quality_reason": F.col("_verdict.reason"),
        }
    ).drop("_verdict")


def missing(column: str) -> Column:
    return F.col(column).isNull()


def negative(column: str) -> Column:
    return F.col(column) < 0


def unreadable(column: str) -> Column:
    """The source held text that did not convert (flag set by the cleaning step)."""
    return F.col(flag(column))


def flag(column: str) -> str:
    return f"{column}_unreadable"


def _before(first: str, second: str) -> Column:
    return F.col(first) < F.col(second)


PURCHASE = "order_purchase_timestamp"
CARRIER = "order_delivered_carrier_date"
CUSTOMER = "order_delivered_customer_date"
ESTIMATE = "order_estimated_delivery_date"


def _date_order() -> list[Rule]:
    return [
        (_before(CARRIER, PURCHASE), CHECK, "Carrier delivery before purchase"),
        (_before(CUSTOMER, PURCHASE), CHECK, "Customer delivery before purchase"),
        (_before(CUSTOMER, CARRIER), CHECK, "Customer delivery before carrier"),
        (_before(ESTIMATE, PURCHASE), CHECK, "Estimated delivery before purchase"),
    ]


def order_rules() -> list[Rule]:
    return [
        (missing("order_id"), REJECTED, "Missing order_id"),
        (missing(PURCHASE), CHECK, "Missing or invalid purchase timestamp"),
        (missing("order_status"), CHECK, "Missing order status"),
        (_before("order_approved_at", PURCHASE), CHECK, "Approved before purchase"),
        *_date_order(),
    ]


def delivery_rules() -> list[Rule]:
    return [
        (missing("order_id"), REJECTED, "Missing order_id"),
        (missing(PURCHASE), CHECK, "Missing purchase timestamp"),
        *_date_order(),
    ]


def order_item_rules() -> list[Rule]:
    return [
        (missing("order_id"), REJECTED, "Missing order_id"),
        (missing("order_item_id"), REJECTED, "Missing or invalid order_item_id"),
        (F.col("order_item_id") <= 0, REJECTED, "Invalid order_item_id"),
        (missing("product_id"), REJECTED, "Missing product_id"),
        (missing("seller_id"), REJECTED, "Missing seller_id"),
        (missing("price"), CHECK, "Missing or invalid price"),
        (negative("price"), CHECK, "Negative price"),
        (missing("freight_value"), CHECK, "Missing or invalid freight_value"),
        (negative("freight_value"), CHECK, "Negative freight_value"),
        (missing("shipping_limit_date"), CHECK, "Missing or invalid shipping_limit_date"),
    ]


def payment_rules() -> list[Rule]:
    return [
        (missing("order_id"), REJECTED, "Missing order_id"),
        (missing("payment_sequential"), REJECTED, "Missing or invalid payment_sequential"),
        (F.col("payment_sequential") <= 0, REJECTED, "Invalid payment_sequential"),
        (missing("payment_type"), CHECK, "Missing payment_type"),
        (unreadable("payment_installments"), CHECK, "Invalid payment_installments"),
        (negative("payment_installments"), CHECK, "Negative payment_installments"),
        (unreadable("payment_value"), CHECK, "Invalid payment_value"),
        (negative("payment_value"), CHECK, "Negative payment_value"),
    ]


def customer_rules() -> list[Rule]:
    return [
        (missing("customer_id"), REJECTED, "Missing customer_id"),
        (missing("customer_unique_id"), REJECTED, "Missing customer_unique_id"),
        (bad_zip(F.col("customer_zip_code_prefix")), CHECK, "Invalid customer_zip_code_prefix"),
        (missing("customer_city"), CHECK, "Missing customer_city"),
        (missing("customer_state"), CHECK, "Missing customer_state"),
    ]


def seller_rules() -> list[Rule]:
    return [
        (missing("seller_id"), REJECTED, "Missing seller_id"),
        (bad_zip(F.col("seller_zip_code_prefix")), CHECK, "Invalid seller_zip_code_prefix"),
        (missing("seller_city"), CHECK, "Missing seller_city"),
        (missing("seller_state"), CHECK, "Missing seller_state"),
        (F.length("seller_state") != 2, CHECK, "Invalid seller_state_code"),
    ]


PRODUCT_MEASURES = (
    "product_name_length", "product_description_length", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
)


def product_rules() -> list[Rule]:
    return [
        (missing("product_id"), REJECTED, "Missing product_id"),
        (missing("product_category_name"), CHECK, "Missing product category"),
        *[(unreadable(name), CHECK, f"Invalid {name}") for name in PRODUCT_MEASURES],
        *[(negative(name), CHECK, f"Negative {name}") for name in PRODUCT_MEASURES],
    ]


RULES: dict[str, Callable[[], list[Rule]]] = {
    "orders": order_rules,
    "order_items": order_item_rules,
    "order_payments": payment_rules,
    "customers": customer_rules,
    "sellers": seller_rules,
    "products": product_rules,
    "delivery": delivery_rules,
}

# Columns whose rule tells unreadable text apart from absent text.
FLAGGED: dict[str, tuple[str, ...]] = {
    "order_payments": ("payment_installments", "payment_value"),
    "products": PRODUCT_MEASURES,
}
