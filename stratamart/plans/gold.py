"""Star schema sources: dimensions, the date dimension and the three facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.dates import date_key
from stratamart.functions.text import clean
from stratamart.operators.latest import latest
from stratamart.operators.rules import CARRIER, CUSTOMER, ESTIMATE, PURCHASE, REJECTED
from stratamart.schemas import GOLD

REASON = "reject_reason"
LOADABLE = "loadable"
#: The partner rows that a candidate's outcome rests on, each as table:key.
DEPENDS_ON = "depends_on"
#: The silver row of a candidate that lacks a key.
SOURCE = "source_row"


def _not_rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("data_quality_status") != REJECTED)


# --- dimensions -------------------------------------------------------------------------------


def customer_source(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer_unique_id, attributes from the customer_id with the latest purchase.

    Only the latest purchase per customer_id matters, so orders shrink to one row per customer
    before the join; a customer with a huge share of the orders never fans the join out.
    """
    last_purchase = orders.groupBy("customer_id").agg(F.max(PURCHASE).alias("_last_purchase"))
    order = [
        F.col("_last_purchase").desc_nulls_last(),
        F.col("source_load_datetime").desc_nulls_last(),
        F.col("source_load_id").desc_nulls_last(),
        F.col("customer_id").asc(),
    ]
    seen = customers.select(
        "customer_unique_id", "customer_id", "customer_zip_code_prefix", "customer_city", "customer_state",
        "source_load_datetime", "source_load_id",
    ).join(last_purchase, "customer_id", "left")
    return latest(seen, ["customer_unique_id"], order).select(*_attributes("dim_customer"))


def category_lookup(translation: DataFrame) -> DataFrame:
    """One English name per category; both names are cleaned, so quoted files match too."""
    return (
        translation.select(
            clean("product_category_name").alias("product_category_name"),
            clean("product_category_name_english").alias("product_category_name_english"),
        )
        .groupBy("product_category_name")
        .agg(F.max("product_category_name_english").alias("product_category_name_english"))
    )


def product_source(products: DataFrame, translation: DataFrame) -> DataFrame:
    named = _not_rejected(products).join(category_lookup(translation), "product_category_name", "left")
    return named.select(*_attributes("dim_product"))


def seller_source(sellers: DataFrame) -> DataFrame:
    return _not_rejected(sellers).select(*_attributes("dim_seller"))


def _attributes(name: str) -> list[str]:
    spec = GOLD[name]
    return [c for c in spec.schema.fieldNames() if c != spec.surrogate]


def date_attributes(day: Column) -> list[Column]:
    """Columns of the date dimension for one day: ISO week, day_of_week 1 = Sunday."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    ]


def date_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from start to end."""
    bounds = spark.range(1).select(F.lit(start).alias("_first"), F.lit(end).alias("_last"))
    return _days(bounds)


def date_dim_of(orders: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Whole years from the first purchase to the year after the last one; a given bound stands."""
    seen = orders.agg(F.min(PURCHASE).alias("_min"), F.max(PURCHASE).alias("_max"))
    first = F.make_date(F.year("_min"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("_max") + 1, F.lit(12), F.lit(31))
    bounds = seen.select(
        F.coalesce(F.lit(start).cast("date"), first).alias("_first"), F.coalesce(F.lit(end).cast("date"), last).alias("_last")
    )
    return _days(bounds.where("_first <= _last"))


def _days(bounds: DataFrame) -> DataFrame:
    days = bounds.select(F.explode(F.sequence("_first", "_last", F.expr("interval 1 day"))).alias("_day"))
    return days.select(*date_attributes(F.col("_day")))


# --- facts ------------------------------------------------------------------------------------


def customer_lookup(customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """customer_id to customer_key through the unique id."""
    return customers.select("customer_id", "customer_unique_id").join(
        dim_customer.select("customer_unique_id", "customer_key"), "customer_unique_id"
    ).select("customer_id", "customer_key")


def order_lookup(orders: DataFrame, customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """order_id to the customer's ids and key and the date key: narrow columns for the wide fact join.

    A customer that is not there leaves its columns NULL, so that an item can tell what it lacks.
    """
    bought = orders.select("order_id", "customer_id", date_key(F.col(PURCHASE)).alias("order_date_key"))
    return bought.join(_customers(customers, dim_customer), "customer_id", "left").select(
        "order_id", "customer_id", "customer_unique_id", "customer_key", "order_date_key"
    )


def _customers(customers: DataFrame, dim_customer: DataFrame) -> DataFrame:
    keys = dim_customer.select("customer_unique_id", "customer_key")
    return customers.select("customer_id", "customer_unique_id").join(keys, "customer_unique_id", "left")


def _rests_on(keyed: DataFrame, orders: bool, **members: tuple[str, str]) -> Column:
    """The order, its customer and the members whose key is not there; a lookup without the customer's ids names none."""
    parts = [F.concat(F.lit("orders:"), F.col("order_id"))] if orders else []
    if "customer_id" in keyed.columns:
        parts.append(F.concat(F.lit("customers:"), F.col("customer_id")))
    if "customer_unique_id" in keyed.columns:
        members = {"dim_customer": ("customer_unique_id", "customer_key"), **members}
    parts += [F.when(F.col(key).isNull(), F.concat(F.lit(f"{dim}:"), F.col(natural))) for dim, (natural, key) in members.items()]
    return F.array_compact(F.array(*parts)).alias(DEPENDS_ON)


def _reasons(*tests: tuple[str, str]) -> Column:
    reason = None
    for column, text in tests:
        lost = F.col(column).isNull()
        reason = F.when(lost, text) if reason is None else reason.when(lost, text)
    return reason.otherwise(LOADABLE)


def _lost(whole: Sequence[str]) -> list[Column]:
    """The columns `whole` of a candidate that is not loadable, if any are wanted."""
    return [F.when(F.col(REASON) != LOADABLE, F.struct(*whole)).alias(SOURCE)] if whole else []


def sales_candidates(
    items: DataFrame, lookup: DataFrame, dim_product: DataFrame, dim_seller: DataFrame, whole: Sequence[str] = ()
) -> DataFrame:
    """Items with their dimension keys and, where a key is lost, the reason.

    Left joins instead of inner ones, so that rows without a partner are counted in the same
    pass. The items are the left side throughout: where a product or an order holds a large
    share of them, Spark splits that side of the join at run time, and a dimension below the
    broadcast threshold is not shuffled at all. The lookup comes last: what it adds, the customer's ids among
    it, is then not shuffled for another join. An item that lacks a key takes its columns `whole` along,
    so that nobody has to join it to the items again.
    """
    narrow = ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    keyed = (
        items.select(*dict.fromkeys((*narrow, *whole)))
        .join(dim_product.select("product_id", "product_key"), "product_id", "left")
        .join(dim_seller.select("seller_id", "seller_key"), "seller_id", "left")
        .join(lookup, "order_id", "left")
    )
    reason = _reasons(
        ("customer_key", "No order or customer"),
        ("product_key", "No product"),
        ("seller_key", "No seller"),
        ("order_date_key", "No purchase date"),
    )
    rests_on = _rests_on(keyed, True, dim_product=("product_id", "product_key"), dim_seller=("seller_id", "seller_key"))
    return keyed.withColumn(REASON, reason).select(*_attributes("fact_sales"), REASON, rests_on, *_lost(whole))


def payment_candidates(payments: DataFrame, lookup: DataFrame, whole: Sequence[str] = ()) -> DataFrame:
    narrow = ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
    keyed = payments.select(*dict.fromkeys((*narrow, *whole))).join(lookup, "order_id", "left")
    reason = _reasons(("customer_key", "No order or customer"), ("order_date_key", "No purchase date"))
    return keyed.withColumn(REASON, reason).select(*_attributes("fact_payments"), REASON, _rests_on(keyed, True), *_lost(whole))


def delivery_candidates(delivery: DataFrame, customers: DataFrame, dim_customer: DataFrame, whole: Sequence[str] = ()) -> DataFrame:
    """Deliveries with their customer and four date keys, each NULL where the date is."""
    keyed = delivery.join(_customers(customers, dim_customer), "customer_id", "left").withColumns(
        {
            "purchase_date_key": date_key(F.col(PURCHASE)),
            "carrier_date_key": date_key(F.col(CARRIER)),
            "delivered_date_key": date_key(F.col(CUSTOMER)),
            "estimated_delivery_date_key": date_key(F.col(ESTIMATE)),
        }
    )
    return keyed.withColumn(REASON, _reasons(("customer_key", "No customer"))).select(
        *_attributes("fact_delivery"), REASON, _rests_on(keyed, False), *_lost(whole)
    )


def loadable(candidates: DataFrame) -> DataFrame:
    """Candidates that lack nothing.

    The keys are also tested one by one: straight after the star join this tells Spark that its
    left joins may run as inner ones, and over stored candidates it reaches the scan.
    """
    needed = [k for k in ("customer_key", "product_key", "seller_key", "order_date_key") if k in candidates.columns]
    complete = candidates
    for key in needed:
        complete = complete.where(F.col(key).isNotNull())
    return complete.where(F.col(REASON) == LOADABLE).drop(REASON, DEPENDS_ON, SOURCE)


def order_month(key: Column) -> Column:
    """yyyymm of a date key, 0 without a date: the folder a fact row is stored in."""
    return F.coalesce(F.floor(key / 100).cast("int"), F.lit(0))
