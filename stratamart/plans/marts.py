"""Dashboard measures over the star schema, each with the slicers year, month, state, category.

Facts are summed per dimension key before they meet the dimension: partial sums run before the
shuffle, so a hot product or customer travels as one row per task, and the join handles one row
per member instead of one per sale. Year and month also name the fact's ``order_month`` folders,
so a slice reads only those.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Star = Mapping[str, DataFrame]
TOTAL = "decimal(38,2)"


def _in_period(fact: DataFrame, year: int | None, month: int | None) -> DataFrame:
    if year is not None:
        fact = fact.where(F.col("order_month").between(year * 100 + 1, year * 100 + 12))
    if month is not None:
        fact = fact.where(F.col("order_month") % 100 == month)
    return fact


def _of_customers(gold: Star, fact: DataFrame, state: str | None) -> DataFrame:
    if state is None:
        return fact
    members = gold["dim_customer"].where(F.col("customer_state") == state).select("customer_key")
    return fact.join(members, "customer_key", "left_semi")


def _of_products(gold: Star, fact: DataFrame, category: str | None) -> DataFrame:
    if category is None:
        return fact
    members = gold["dim_product"].where(F.col("product_category_name") == category).select("product_key")
    return fact.join(members, "product_key", "left_semi")


def sales(gold: Star, year=None, month=None, state=None, category=None) -> DataFrame:
    """FactSales under the slicers."""
    fact = _in_period(gold["fact_sales"], year, month)
    return _of_products(gold, _of_customers(gold, fact, state), category)


def deliveries(gold: Star, year=None, month=None, state=None) -> DataFrame:
    """FactDelivery under the slicers, by purchase date. A product category does not reach orders."""
    return _of_customers(gold, _in_period(gold["fact_delivery"], year, month), state)


def payments(gold: Star, year=None, month=None, state=None) -> DataFrame:
    return _of_customers(gold, _in_period(gold["fact_payments"], year, month), state)


def _total(column: str = "price"):
    return F.sum(column).cast(TOTAL)


def kpi_overview(gold: Star, year=None, month=None, state=None, category=None) -> DataFrame:
    """Total sales, orders, products, customers and average delivery days in one row.

    Products follow the category slicer and customers the state slicer, as their dimensions do.
    """
    products, customers = gold["dim_product"], gold["dim_customer"]
    if category is not None:
        products = products.where(F.col("product_category_name") == category)
    if state is not None:
        customers = customers.where(F.col("customer_state") == state)
    parts = [
        sales(gold, year, month, state, category).agg(_total().alias("total_sales")),
        deliveries(gold, year, month, state).agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.round(F.avg("delivery_days"), 6).alias("avg_delivery_days"),
        ),
        products.agg(F.count(F.lit(1)).alias("total_products")),
        customers.agg(F.count(F.lit(1)).alias("total_customers")),
    ]
    # Each part is one row with its own columns; stacked, every column holds one value.
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    measures = ["total_sales", "total_orders", "total_products", "total_customers", "avg_delivery_days"]
    return stacked.agg(*[F.max(name).alias(name) for name in measures])


def sales_trend(gold: Star, year=None, month=None, state=None, category=None) -> DataFrame:
    """Sales and item count by year and month of purchase."""
    per_day = (
        sales(gold, year, month, state, category)
        .groupBy(F.col("order_date_key").alias("date_key"))
        .agg(F.sum("price").alias("_sales"), F.count(F.lit(1)).alias("_items"))
    )
    calendar = gold["dim_date"].select("date_key", "year", "month", "month_name")
    return (
        per_day.join(calendar, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(_total("_sales").alias("total_sales"), F.sum("_items").alias("items_sold"))
    )


def orders_by_status(gold: Star, year=None, month=None, state=None) -> DataFrame:
    return deliveries(gold, year, month, state).groupBy("delivery_status").agg(F.count(F.lit(1)).alias("orders"))


def _sales_by(gold: Star, fact: DataFrame, dim: str, key: str, label: str) -> DataFrame:
    """Sales per value of a dimension attribute."""
    per_member = fact.groupBy(key).agg(F.sum("price").alias("_sales"))
    return (
        per_member.join(gold[dim].select(key, label), key)
        .groupBy(label)
        .agg(_total("_sales").alias("total_sales"))
    )


def _top(ranked: DataFrame, label: str, n: int) -> DataFrame:
    return ranked.orderBy(F.col("total_sales").desc_nulls_last(), F.col(label).asc_nulls_last()).limit(n)


def top_categories(gold: Star, n: int = 5, year=None, month=None, state=None, category=None) -> DataFrame:
    """Best selling categories; the English name where there is one, else the original."""
    fact = sales(gold, year, month, state, category)
    per_product = fact.groupBy("product_key").agg(F.sum("price").alias("_sales"))
    name = F.coalesce("product_category_name_english", "product_category_name", F.lit("Unknown"))
    named = gold["dim_product"].select("product_key", name.alias("category"))
    ranked = per_product.join(named, "product_key").groupBy("category").agg(_total("_sales").alias("total_sales"))
    return _top(ranked, "category", n)


def top_sellers(gold: Star, n: int = 5, year=None, month=None, state=None, category=None) -> DataFrame:
    ranked = _sales_by(gold, sales(gold, year, month, state, category), "dim_seller", "seller_key", "seller_id")
    return _top(ranked, "seller_id", n)


def top_cities(gold: Star, n: int = 5, year=None, month=None, state=None, category=None) -> DataFrame:
    ranked = _sales_by(gold, sales(gold, year, month, state, category), "dim_customer", "customer_key", "customer_city")
    return _top(ranked, "customer_city", n)


def payments_by_type(gold: Star, year=None, month=None, state=None) -> DataFrame:
    return (
        payments(gold, year, month, state)
        .groupBy("payment_type")
        .agg(_total("payment_value").alias("total_value"), F.count(F.lit(1)).alias("payments"))
    )


def customers_by_state(gold: Star, year=None, month=None, state=None, category=None) -> DataFrame:
    """Customers, their orders and their sales per state."""
    bought = sales(gold, year, month, category=category).groupBy("customer_key").agg(F.sum("price").alias("_sales"))
    ordered = deliveries(gold, year, month).groupBy("customer_key").agg(F.count(F.lit(1)).alias("_orders"))
    members = gold["dim_customer"].select("customer_key", "customer_state")
    return (
        (members if state is None else members.where(F.col("customer_state") == state))
        .join(ordered, "customer_key", "left")
        .join(bought, "customer_key", "left")
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("orders"),
            _total("_sales").alias("total_sales"),
        )
    )


def delivery_performance(gold: Star, year=None, month=None, state=None) -> DataFrame:
    """Delivered orders by status: count, mean days, mean delay; and the share of all delivered."""
    delivered = deliveries(gold, year, month, state).where(F.col("delivery_status") != "Not Delivered")
    per_status = delivered.groupBy("delivery_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.avg("delivery_days"), 6).alias("avg_delivery_days"),
        F.round(F.avg("delivery_delay_days"), 6).alias("avg_delay_days"),
    )
    # Four statuses at most, so the total over them is a window on four rows.
    everything = F.sum("orders").over(Window.partitionBy())
    return per_status.withColumn("share_of_delivered", F.round(F.col("orders") / everything, 6))
