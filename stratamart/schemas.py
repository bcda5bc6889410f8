"""Table registry: columns, types and keys of every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT = T.StringType()
INT = T.IntegerType()
LONG = T.LongType()
MONEY = T.DecimalType(18, 2)
STAMP = T.TimestampNTZType()
DATE = T.DateType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- bronze: every source column is text ------------------------------------------------------
# The column names of the source files, in file order.

BRONZE: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
    "order_payments": (
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ),
    "order_reviews": (
        "review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
        "review_creation_date", "review_answer_timestamp",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city",
        "geolocation_state",
    ),
    "category_translation": ("product_category_name", "product_category_name_english"),
}

LOAD_COLUMNS = table(load_id=LONG, load_datetime=STAMP, source_file=TEXT)


def raw_schema(name: str) -> T.StructType:
    """Text columns of one source file."""
    return table(**{column: TEXT for column in BRONZE[name]})


def bronze_schema(name: str) -> T.StructType:
    """Source columns plus the load metadata."""
    return T.StructType(raw_schema(name).fields + LOAD_COLUMNS.fields)


# --- silver: cleaned and typed ----------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One silver column: where it comes from and how it is converted.

    ``form`` is one of text, lower, upper, state, int, money, stamp.
    """

    name: str
    form: str = "text"
    source: str | None = None

    @property
    def raw(self) -> str:
        return self.source or self.name

    @property
    def type(self) -> T.DataType:
        return {"int": INT, "money": MONEY, "stamp": STAMP}.get(self.form, TEXT)


@dataclass(frozen=True)
class SilverTable:
    name: str
    keys: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [field.name for field in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields] + LINEAGE.fields)


LINEAGE = table(
    data_quality_status=TEXT,
    data_quality_reason=TEXT,
    source_load_id=LONG,
    source_load_datetime=STAMP,
    source_file=TEXT,
)

SILVER: dict[str, SilverTable] = {
    t.name: t
    for t in (
        SilverTable(
            "orders",
            ("order_id",),
            (
                Field("order_id"),
                Field("customer_id"),
                Field("order_status", "upper"),
                Field("order_purchase_timestamp", "stamp"),
                Field("order_approved_at", "stamp"),
                Field("order_delivered_carrier_date", "stamp"),
                Field("order_delivered_customer_date", "stamp"),
                Field("order_estimated_delivery_date", "stamp"),
            ),
        ),
        SilverTable(
            "order_items",
            ("order_id", "order_item_id"),
            (
                Field("order_id"),
                Field("order_item_id", "int"),
                Field("product_id"),
                Field("seller_id"),
                Field("shipping_limit_date", "stamp"),
                Field("price", "money"),
                Field("freight_value", "money"),
            ),
        ),
        SilverTable(
            "order_payments",
            ("order_id", "payment_sequential"),
            (
                Field("order_id"),
                Field("payment_sequential", "int"),
                Field("payment_type", "lower"),
                Field("payment_installments", "int"),
                Field("payment_value", "money"),
            ),
        ),
        SilverTable(
            "customers",
            ("customer_id",),
            (
                Field("customer_id"),
                Field("customer_unique_id"),
                Field("customer_zip_code_prefix"),
                Field("customer_city", "lower"),
                Field("customer_state", "upper"),
            ),
        ),
        SilverTable(
            "sellers",
            ("seller_id",),
            (
                Field("seller_id"),
                Field("seller_zip_code_prefix"),
                Field("seller_city", "lower"),
                Field("seller_state", "state"),
            ),
        ),
        SilverTable(
            "products",
            ("product_id",),
            (
                Field("product_id"),
                Field("product_category_name"),
                Field("product_name_length", "int", "product_name_lenght"),
                Field("product_description_length", "int", "product_description_lenght"),
                Field("product_photos_qty", "int"),
                Field("product_weight_g", "money"),
                Field("product_length_cm", "money"),
                Field("product_height_cm", "money"),
                Field("product_width_cm", "money"),
            ),
        ),
        SilverTable(
            "delivery",
            ("order_id",),
            (
                Field("order_id"),
                Field("customer_id"),
                Field("order_purchase_timestamp", "stamp"),
                Field("order_delivered_carrier_date", "stamp"),
                Field("order_delivered_customer_date", "stamp"),
                Field("order_estimated_delivery_date", "stamp"),
                Field("delivery_days", "int"),
                Field("delivery_delay_days", "int"),
                Field("delivery_status"),
            ),
        ),
    )
}

# --- gold: star schema ------------------------------------------------------------------------


@dataclass(frozen=True)
class GoldTable:
    name: str
    surrogate: str | None
    keys: tuple[str, ...]
    schema: T.StructType
    required: tuple[str, ...]


def _gold(name, surrogate, keys, required=(), **columns):
    every = tuple(c for c in (surrogate, *keys, *required) if c)
    return GoldTable(name, surrogate, tuple(keys), table(**columns), tuple(dict.fromkeys(every)))


GOLD: dict[str, GoldTable] = {
    t.name: t
    for t in (
        _gold(
            "dim_date", None, ["date_key"],
            ["full_date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month",
             "day_of_week", "day_name"],
            date_key=INT, full_date=DATE, year=INT, quarter=INT, month=INT, month_name=TEXT, week_of_year=INT,
            day_of_month=INT, day_of_week=INT, day_name=TEXT,
        ),
        _gold(
            "dim_customer", "customer_key", ["customer_unique_id"], ["customer_id"],
            customer_key=LONG, customer_unique_id=TEXT, customer_id=TEXT, customer_zip_code_prefix=TEXT,
            customer_city=TEXT, customer_state=TEXT,
        ),
        _gold(
            "dim_product", "product_key", ["product_id"],
            product_key=LONG, product_id=TEXT, product_category_name=TEXT, product_category_name_english=TEXT,
            product_name_length=INT, product_description_length=INT, product_photos_qty=INT,
            product_weight_g=MONEY, product_length_cm=MONEY, product_height_cm=MONEY, product_width_cm=MONEY,
        ),
        _gold(
            "dim_seller", "seller_key", ["seller_id"],
            seller_key=LONG, seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT,
        ),
        _gold(
            "fact_sales", "sales_key", ["order_id", "order_item_id"],
            ["customer_key", "product_key", "seller_key", "order_date_key"],
            sales_key=LONG, order_id=TEXT, order_item_id=INT, customer_key=LONG, product_key=LONG, seller_key=LONG,
            order_date_key=INT, price=MONEY, freight_value=MONEY,
        ),
        _gold(
            "fact_payments", "payment_key", ["order_id", "payment_sequential"],
            ["customer_key", "order_date_key"],
            payment_key=LONG, order_id=TEXT, payment_sequential=INT, customer_key=LONG, order_date_key=INT,
            payment_type=TEXT, payment_installments=INT, payment_value=MONEY,
        ),
        _gold(
            "fact_delivery", "delivery_key", ["order_id"], ["customer_key", "delivery_status"],
            delivery_key=LONG, order_id=TEXT, customer_key=LONG, purchase_date_key=INT, carrier_date_key=INT,
            delivered_date_key=INT, estimated_delivery_date_key=INT, delivery_days=INT, delivery_delay_days=INT,
            delivery_status=TEXT,
        ),
    )
}

#: Columns whose sums each commit carries, beside its rows.
TOTALS: dict[str, tuple[str, ...]] = {name: () for name in SILVER} | {
    "order_items": ("price", "freight_value"),
    "order_payments": ("payment_value",),
    "delivery": ("delivery_days", "delivery_delay_days"),
    "fact_sales": ("price", "freight_value"),
    "fact_payments": ("payment_value",),
    "fact_delivery": ("delivery_days", "delivery_delay_days"),
}
TOTAL = "decimal(38,2)"

# --- load control -----------------------------------------------------------------------------

BATCH_CONTROL = table(
    batch_id=LONG, pipeline_name=TEXT, source_name=TEXT, source_batch_key=TEXT, status=TEXT,
    batch_start_time=STAMP, batch_end_time=STAMP, rows_loaded=LONG,
)
RUN_LOG = table(
    run_id=LONG, pipeline_name=TEXT, status=TEXT, start_time=STAMP, end_time=STAMP, rows_extracted=LONG,
    rows_loaded=LONG, rows_rejected=LONG, error_message=TEXT,
)
PIPELINE_CONTROL = T.StructType(
    table(pipeline_name=TEXT, watermark_value=TEXT, last_successful_run=STAMP, is_active=INT, version=LONG).fields
    + [
        T.StructField("load_ids", T.ArrayType(LONG)),
        T.StructField("whole", T.BooleanType()),
        T.StructField("seen", TEXT),
    ]
)
