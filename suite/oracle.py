"""The same queries in SQL for DuckDB, written apart from the Spark code.

Each piece is a CTE; ``sql(final)`` puts the pieces a query names, and those they name in turn,
in front of it.
"""

from __future__ import annotations

import re

from suite.fixtures import BRONZE_SQL, duckdb_text

PIECES: dict[str, str] = {f"bronze_{name}": duckdb_text(name) for name in BRONZE_SQL}


def sql(final: str) -> str:
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\w+", text):
            if name in PIECES and name not in order and PIECES[name] is not text:
                visit(PIECES[name])
                if name not in order:
                    order.append(name)

    visit(final)
    # Nested WITH inside a CTE is fine in DuckDB, so the bronze projections are pasted as they are.
    heads = ",\n".join(f"{name} AS MATERIALIZED ({PIECES[name]})" for name in order)
    return f"WITH {heads}\n{final.strip()}" if heads else final.strip()


# --- conversions ------------------------------------------------------------------------------


def text(column: str) -> str:
    return f"nullif(trim(replace({column}, '\"', '')), '')"


def integer(value: str) -> str:
    return f"CASE WHEN regexp_full_match({value}, '[+-]?[0-9]+') THEN try_cast({value} AS INTEGER) END"


def money(value: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({value}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)') "
        f"THEN try_cast({value} AS DECIMAL(18,2)) END"
    )


def moment(value: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({value}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}"
        f"([ T][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]{{1,7}})?)?)?') "
        f"THEN try_cast({value} AS TIMESTAMP) END"
    )


def datekey(value: str) -> str:
    return f"CAST(year({value}) * 10000 + month({value}) * 100 + day({value}) AS INTEGER)"


def daydiff(start: str, end: str) -> str:
    return f"CAST(date_diff('day', {start}, {end}) AS INTEGER)"


LOAD = "load_id, load_datetime, source_file"
NEWEST = "load_datetime DESC NULLS LAST, load_id DESC NULLS LAST"


def first_per(source: str, keys: str, ties: list[str]) -> str:
    order = ", ".join([NEWEST, *[f"{t} ASC NULLS LAST" for t in ties]])
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"


def verdict(rules: list[tuple[str, str, str]]) -> str:
    status = " ".join(f"WHEN {test} THEN '{s}'" for test, s, _ in rules)
    reason = " ".join(f"WHEN {test} THEN '{r}'" for test, _, r in rules)
    return (
        f"CASE {status} ELSE 'VALID' END AS data_quality_status, "
        f"CASE {reason} END AS data_quality_reason"
    )


LINEAGE = "load_id AS source_load_id, load_datetime AS source_load_datetime, source_file"

# --- orders -----------------------------------------------------------------------------------

ORDER_DATES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]
ORDER_COLUMNS = ["order_id", "customer_id", "order_status", *ORDER_DATES]
PIECES["clean_orders"] = f"""
SELECT {text('order_id')} AS order_id, {text('customer_id')} AS customer_id,
       upper({text('order_status')}) AS order_status,
       {', '.join(f"{moment(text(c))} AS {c}" for c in ORDER_DATES)}, {LOAD}
FROM bronze_orders"""
ORDER_RULES = [
    ("order_id IS NULL", "REJECTED", "Missing order_id"),
    ("order_purchase_timestamp IS NULL", "CHECK", "Missing or invalid purchase timestamp"),
    ("order_status IS NULL", "CHECK", "Missing order status"),
    ("order_approved_at < order_purchase_timestamp", "CHECK", "Approved before purchase"),
    ("order_delivered_carrier_date < order_purchase_timestamp", "CHECK", "Carrier delivery before purchase"),
    ("order_delivered_customer_date < order_purchase_timestamp", "CHECK", "Customer delivery before purchase"),
    ("order_delivered_customer_date < order_delivered_carrier_date", "CHECK", "Customer delivery before carrier"),
    ("order_estimated_delivery_date < order_purchase_timestamp", "CHECK", "Estimated delivery before purchase"),
]
DELIVERY_RULES = [
    ORDER_RULES[0], ("order_purchase_timestamp IS NULL", "CHECK", "Missing purchase timestamp"), *ORDER_RULES[4:],
]

# --- order items ------------------------------------------------------------------------------

ITEM_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
]
PIECES["clean_order_items"] = f"""
SELECT {text('order_id')} AS order_id, {integer(text('order_item_id'))} AS order_item_id,
       {text('product_id')} AS product_id, {text('seller_id')} AS seller_id,
       {moment(text('shipping_limit_date'))} AS shipping_limit_date, {money(text('price'))} AS price,
       {money(text('freight_value'))} AS freight_value, {LOAD}
FROM bronze_order_items"""
ITEM_RULES = [
    ("order_id IS NULL", "REJECTED", "Missing order_id"),
    ("order_item_id IS NULL", "REJECTED", "Missing or invalid order_item_id"),
    ("order_item_id <= 0", "REJECTED", "Invalid order_item_id"),
    ("product_id IS NULL", "REJECTED", "Missing product_id"),
    ("seller_id IS NULL", "REJECTED", "Missing seller_id"),
    ("price IS NULL", "CHECK", "Missing or invalid price"),
    ("price < 0", "CHECK", "Negative price"),
    ("freight_value IS NULL", "CHECK", "Missing or invalid freight_value"),
    ("freight_value < 0", "CHECK", "Negative freight_value"),
    ("shipping_limit_date IS NULL", "CHECK", "Missing or invalid shipping_limit_date"),
]

# --- payments ---------------------------------------------------------------------------------

PAYMENT_COLUMNS = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]
PIECES["clean_order_payments"] = f"""
SELECT {text('order_id')} AS order_id, {integer(text('payment_sequential'))} AS payment_sequential,
       lower({text('payment_type')}) AS payment_type,
       {integer(text('payment_installments'))} AS payment_installments,
       {money(text('payment_value'))} AS payment_value,
       {text('payment_installments')} AS raw_installments, {text('payment_value')} AS raw_value, {LOAD}
FROM bronze_order_payments"""
PAYMENT_RULES = [
    ("order_id IS NULL", "REJECTED", "Missing order_id"),
    ("payment_sequential IS NULL", "REJECTED", "Missing or invalid payment_sequential"),
    ("payment_sequential <= 0", "REJECTED", "Invalid payment_sequential"),
    ("payment_type IS NULL", "CHECK", "Missing payment_type"),
    ("payment_installments IS NULL AND raw_installments IS NOT NULL", "CHECK", "Invalid payment_installments"),
    ("payment_installments < 0", "CHECK", "Negative payment_installments"),
    ("payment_value IS NULL AND raw_value IS NOT NULL", "CHECK", "Invalid payment_value"),
    ("payment_value < 0", "CHECK", "Negative payment_value"),
]

# --- customers, sellers, products -------------------------------------------------------------

CUSTOMER_COLUMNS = [
    "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
]
PIECES["clean_customers"] = f"""
SELECT {text('customer_id')} AS customer_id, {text('customer_unique_id')} AS customer_unique_id,
       {text('customer_zip_code_prefix')} AS customer_zip_code_prefix,
       lower({text('customer_city')}) AS customer_city, upper({text('customer_state')}) AS customer_state, {LOAD}
FROM bronze_customers"""
CUSTOMER_RULES = [
    ("customer_id IS NULL", "REJECTED", "Missing customer_id"),
    ("customer_unique_id IS NULL", "REJECTED", "Missing customer_unique_id"),
    ("NOT regexp_full_match(customer_zip_code_prefix, '[0-9]{5}')", "CHECK", "Invalid customer_zip_code_prefix"),
    ("customer_city IS NULL", "CHECK", "Missing customer_city"),
    ("customer_state IS NULL", "CHECK", "Missing customer_state"),
]
SELLER_COLUMNS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
_STATE = f"upper({text('seller_state')})"
STATE = f"CASE WHEN contains({_STATE}, ',') THEN right(trim({_STATE}), 2) ELSE {_STATE} END"
PIECES["clean_sellers"] = f"""
SELECT {text('seller_id')} AS seller_id, {text('seller_zip_code_prefix')} AS seller_zip_code_prefix,
       lower({text('seller_city')}) AS seller_city, {STATE} AS seller_state, {LOAD}
FROM bronze_sellers"""
SELLER_RULES = [
    ("seller_id IS NULL", "REJECTED", "Missing seller_id"),
    ("NOT regexp_full_match(seller_zip_code_prefix, '[0-9]{5}')", "CHECK", "Invalid seller_zip_code_prefix"),
    ("seller_city IS NULL", "CHECK", "Missing seller_city"),
    ("seller_state IS NULL", "CHECK", "Missing seller_state"),
    ("length(seller_state) <> 2", "CHECK", "Invalid seller_state_code"),
]
PRODUCT_INTS = {
    "product_name_length": "product_name_lenght",
    "product_description_length": "product_description_lenght",
    "product_photos_qty": "product_photos_qty",
}
PRODUCT_MONEY = ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]
PRODUCT_NUMBERS = [*PRODUCT_INTS, *PRODUCT_MONEY]
PRODUCT_COLUMNS = ["product_id", "product_category_name", *PRODUCT_NUMBERS]
PIECES["clean_products"] = f"""
SELECT {text('product_id')} AS product_id, {text('product_category_name')} AS product_category_name,
       {', '.join(f"{integer(text(raw))} AS {name}" for name, raw in PRODUCT_INTS.items())},
       {', '.join(f"{money(text(name))} AS {name}" for name in PRODUCT_MONEY)},
       {', '.join(f"{text(PRODUCT_INTS.get(name, name))} AS raw_{name}" for name in PRODUCT_NUMBERS)}, {LOAD}
FROM bronze_products"""
PRODUCT_RULES = [
    ("product_id IS NULL", "REJECTED", "Missing product_id"),
    ("product_category_name IS NULL", "CHECK", "Missing product category"),
    *[(f"{n} IS NULL AND raw_{n} IS NOT NULL", "CHECK", f"Invalid {n}") for n in PRODUCT_NUMBERS],
    *[(f"{n} < 0", "CHECK", f"Negative {n}") for n in PRODUCT_NUMBERS],
]

TABLES = {
    "orders": (ORDER_COLUMNS, ["order_id"], ORDER_RULES, []),
    "order_items": (ITEM_COLUMNS, ["order_id", "order_item_id"], ITEM_RULES, []),
    "order_payments": (
        PAYMENT_COLUMNS, ["order_id", "payment_sequential"], PAYMENT_RULES,
        ["(payment_installments IS NULL AND raw_installments IS NOT NULL)",
         "(payment_value IS NULL AND raw_value IS NOT NULL)"],
    ),
    "customers": (CUSTOMER_COLUMNS, ["customer_id"], CUSTOMER_RULES, []),
    "sellers": (SELLER_COLUMNS, ["seller_id"], SELLER_RULES, []),
    "products": (
        PRODUCT_COLUMNS, ["product_id"], PRODUCT_RULES,
        [f"({n} IS NULL AND raw_{n} IS NOT NULL)" for n in PRODUCT_NUMBERS],
    ),
}

for _name, (_columns, _keys, _rules, _flags) in TABLES.items():
    _ties = [c for c in _columns if c not in _keys] + _flags + ["source_file"]
    for _suffix, _source in (
        ("", f"clean_{_name}"),
        ("_1", f"(SELECT * FROM clean_{_name} WHERE load_id = 1)"),
        ("_2", f"(SELECT * FROM clean_{_name} WHERE load_id = 2)"),
    ):
        PIECES[f"newest_{_name}{_suffix}"] = first_per(_source, ", ".join(_keys), _ties)
        PIECES[f"judged_{_name}{_suffix}"] = (
            f"SELECT {', '.join(_columns)}, {verdict(_rules)}, {LINEAGE} FROM newest_{_name}{_suffix}"
        )
        PIECES[f"silver_{_name}{_suffix}"] = (
            f"SELECT * FROM judged_{_name}{_suffix} WHERE data_quality_status IN ('VALID', 'CHECK')"
        )

DELIVERY_DATES = [
    "order_purchase_timestamp", "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
STATUS = f"""CASE WHEN order_delivered_customer_date IS NULL THEN 'Not Delivered'
  WHEN order_estimated_delivery_date IS NULL THEN 'Delivered - No Estimate'
  WHEN {daydiff('order_estimated_delivery_date', 'order_delivered_customer_date')} > 0 THEN 'Late'
  WHEN {daydiff('order_estimated_delivery_date', 'order_delivered_customer_date')} = 0 THEN 'On Time'
  ELSE 'Early' END"""
DELIVERY_DAYS = daydiff("order_purchase_timestamp", "order_delivered_customer_date")
DELAY_DAYS = daydiff("order_estimated_delivery_date", "order_delivered_customer_date")
PIECES["judged_delivery"] = f"""
SELECT order_id, customer_id, {', '.join(DELIVERY_DATES)},
       {DELIVERY_DAYS} AS delivery_days, {DELAY_DAYS} AS delivery_delay_days, {STATUS} AS delivery_status,
       {verdict(DELIVERY_RULES)}, source_load_id, source_load_datetime, source_file
FROM (SELECT * EXCLUDE (data_quality_status, data_quality_reason) FROM silver_orders)"""
PIECES["silver_delivery"] = "SELECT * FROM judged_delivery WHERE data_quality_status IN ('VALID', 'CHECK')"

# --- merges -----------------------------------------------------------------------------------


def merged(name: str, first: str, second: str) -> str:
    """Second load merged into the first; the greater load id wins, absent keys are inserted."""
    columns, keys = TABLES[name][0], TABLES[name][1]
    full = [*columns, "data_quality_status", "data_quality_reason", "source_load_id", "source_load_datetime",
            "source_file"]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    key = keys[0]
    wins = f"(t.{key} IS NULL OR s.source_load_id > t.source_load_id)"
    picked = ", ".join(f"CASE WHEN s.{key} IS NOT NULL AND {wins} THEN s.{c} ELSE t.{c} END AS {c}" for c in full)
    return f"""
SELECT {picked},
       CASE WHEN t.{key} IS NULL THEN 'inserted'
            WHEN s.source_load_id > t.source_load_id THEN 'updated' ELSE 'kept' END AS change_type
FROM {first} t FULL JOIN {second} s ON {on}"""


PIECES["merged_orders"] = merged("orders", "silver_orders_1", "silver_orders_2")
PIECES["merged_order_items"] = merged("order_items", "silver_order_items_1", "silver_order_items_2")
PIECES["late_order_items"] = merged("order_items", "silver_order_items_2", "silver_order_items_1")

# --- gold -------------------------------------------------------------------------------------


def numbered(source: str, keys: list[str], name: str, kind: str, offset: str = "0") -> str:
    joined = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    order = f"substr(md5({joined}), 1, 3), {', '.join(keys)}"
    return f"SELECT CAST({offset} + row_number() OVER (ORDER BY {order}) AS {kind}) AS {name}, * FROM {source}"


def customers_of(source: str) -> str:
    return f"""
SELECT c.customer_unique_id, c.customer_id, c.customer_zip_code_prefix, c.customer_city, c.customer_state
FROM {source} c LEFT JOIN silver_orders o ON c.customer_id = o.customer_id
QUALIFY row_number() OVER (PARTITION BY c.customer_unique_id
  ORDER BY o.order_purchase_timestamp DESC NULLS LAST, c.source_load_datetime DESC NULLS LAST,
           c.source_load_id DESC NULLS LAST, c.customer_id) = 1"""


PIECES["customer_source"] = customers_of("silver_customers")
PIECES["category_names"] = f"""
SELECT {text('product_category_name')} AS product_category_name,
       max({text('product_category_name_english')}) AS product_category_name_english
FROM bronze_category_translation GROUP BY 1"""
PIECES["product_source"] = f"""
SELECT p.product_id, p.product_category_name, n.product_category_name_english, {', '.join(PRODUCT_NUMBERS)}
FROM silver_products p LEFT JOIN category_names n ON p.product_category_name = n.product_category_name"""
PIECES["seller_source"] = f"SELECT {', '.join(SELLER_COLUMNS)} FROM silver_sellers"
PIECES["dim_customer"] = numbered("customer_source", ["customer_unique_id"], "customer_key", "BIGINT")
PIECES["dim_product"] = numbered("product_source", ["product_id"], "product_key", "BIGINT")
PIECES["dim_seller"] = numbered("seller_source", ["seller_id"], "seller_key", "BIGINT")
PIECES["dim_date"] = f"""
SELECT {datekey('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name
FROM (SELECT CAST(unnest(generate_series(make_timestamp(year(lo), 1, 1, 0, 0, 0),
                                         make_timestamp(year(hi) + 1, 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(order_purchase_timestamp) AS lo, max(order_purchase_timestamp) AS hi FROM silver_orders))"""

PIECES["order_keys"] = f"""
SELECT o.order_id, d.customer_key, {datekey('o.order_purchase_timestamp')} AS order_date_key
FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id
JOIN dim_customer d ON c.customer_unique_id = d.customer_unique_id"""
PIECES["sales_source"] = """
SELECT i.order_id, i.order_item_id, k.customer_key, p.product_key, s.seller_key, k.order_date_key,
       i.price, i.freight_value
FROM silver_order_items i JOIN order_keys k ON i.order_id = k.order_id
JOIN dim_product p ON i.product_id = p.product_id JOIN dim_seller s ON i.seller_id = s.seller_id
WHERE k.order_date_key IS NOT NULL"""
PIECES["payments_source"] = """
SELECT p.order_id, p.payment_sequential, k.customer_key, k.order_date_key, p.payment_type,
       p.payment_installments, p.payment_value
FROM silver_order_payments p JOIN order_keys k ON p.order_id = k.order_id
WHERE k.order_date_key IS NOT NULL"""
PIECES["delivery_source"] = f"""
SELECT d.order_id, k.customer_key, {datekey('d.order_purchase_timestamp')} AS purchase_date_key,
       {datekey('d.order_delivered_carrier_date')} AS carrier_date_key,
       {datekey('d.order_delivered_customer_date')} AS delivered_date_key,
       {datekey('d.order_estimated_delivery_date')} AS estimated_delivery_date_key,
       d.delivery_days, d.delivery_delay_days, d.delivery_status
FROM silver_delivery d JOIN silver_customers c ON d.customer_id = c.customer_id
JOIN dim_customer k ON c.customer_unique_id = k.customer_unique_id"""
PIECES["fact_sales"] = numbered("sales_source", ["order_id", "order_item_id"], "sales_key", "BIGINT")
PIECES["fact_payments"] = numbered("payments_source", ["order_id", "payment_sequential"], "payment_key", "BIGINT")
PIECES["fact_delivery"] = numbered("delivery_source", ["order_id"], "delivery_key", "BIGINT")

# --- one statement per query ------------------------------------------------------------------

ORACLE: dict[str, str] = {}


def oracle(name: str, final: str) -> None:
    ORACLE[name] = sql(final)


KEYS = {
    "orders": "orders", "order_items": "order_items", "payments": "order_payments", "customers": "customers",
    "sellers": "sellers", "products": "products", "delivery": "delivery",
}
for _key, _name in KEYS.items():
    _pk = ", ".join(TABLES[_name][1]) if _name in TABLES else "order_id"
    oracle(f"dq_{_key}", f"SELECT {_pk}, data_quality_status, data_quality_reason FROM judged_{_name}")
    oracle(f"silver_{_key}", f"SELECT * FROM silver_{_name}")

oracle("src_csv_bronze", f"SELECT {', '.join(ORDER_COLUMNS)} FROM clean_orders")
oracle(
    "src_csv_malformed",
    """SELECT count(*) AS rows_loaded, count(*) FILTER (s_suppkey % 10 = 0 OR s_suppkey % 7 = 0) AS rows_malformed,
       count(*) FILTER (s_suppkey % 10 = 0) AS rows_with_surplus FROM supplier""",
)
oracle("src_csv_raw_split", f"SELECT {', '.join(SELLER_COLUMNS)} FROM clean_sellers")
oracle(
    "src_csv_multiline",
    """SELECT CAST(doc_id AS VARCHAR) AS review_id, source AS review_comment_title, length(text) AS message_length,
       md5(text) AS message_digest, '2018-01-02 00:00:00' AS review_answer_timestamp FROM documents""",
)
oracle(
    "src_bronze_generic",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM bronze_{n}" for n in BRONZE_SQL),
)
oracle(
    "src_bronze_stamp",
    """SELECT load_datetime, source_file, count(*) AS row_count, count(DISTINCT load_id) AS load_ids
       FROM bronze_orders GROUP BY ALL""",
)
oracle(
    "src_empty_guard",
    """SELECT 'full' AS source_batch_key, 'Success' AS status, count(*) AS rows_loaded, count(*) AS rows_visible
       FROM bronze_orders
       UNION ALL SELECT 'empty', 'Failed', 0, NULL""",
)
oracle(
    "proj_rename",
    """SELECT product_id, product_name_length, product_description_length, load_id AS source_load_id
       FROM clean_products""",
)
oracle(
    "filter_not_rejected",
    """SELECT order_id, order_item_id, data_quality_status FROM judged_order_items
       WHERE data_quality_status <> 'REJECTED'""",
)
oracle(
    "filter_status_in",
    """SELECT order_id, payment_sequential, data_quality_status FROM judged_order_payments
       WHERE data_quality_status IN ('VALID', 'CHECK')""",
)
oracle("clean_text", "SELECT customer_id, customer_unique_id, customer_city, customer_state FROM clean_customers")
oracle(
    "conv_int",
    f"""SELECT form, {integer('form')} AS value, count(*) AS row_count FROM (
       SELECT CASE l_partkey % 7 WHEN 0 THEN CAST(l_quantity AS VARCHAR) WHEN 1 THEN '+' || l_linenumber
         WHEN 2 THEN '-' || l_linenumber WHEN 3 THEN l_linenumber || 'e2'
         WHEN 4 THEN l_linenumber || '0000000000' WHEN 5 THEN l_linenumber || ' '
         ELSE CAST(l_linenumber AS VARCHAR) END AS form FROM lineitem) GROUP BY ALL""",
)
oracle(
    "conv_decimal",
    f"""SELECT form, {money('form')} AS value, count(*) AS row_count FROM (
       SELECT CASE l_partkey % 7 WHEN 0 THEN l_linenumber || 'e3' WHEN 1 THEN '-' || CAST(l_quantity / 8 AS VARCHAR)
         WHEN 2 THEN '.' || l_linenumber WHEN 3 THEN l_linenumber || '.' WHEN 4 THEN l_linenumber || ',50'
         WHEN 5 THEN l_linenumber || '000000000000000000' ELSE CAST(l_quantity / 8 AS VARCHAR) END AS form
       FROM lineitem) GROUP BY ALL""",
)
oracle(
    "conv_timestamp",
    f"""SELECT form, {moment('form')} AS value, count(*) AS row_count FROM (
       SELECT CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y')
         WHEN 2 THEN strftime(o_orderdate, '%Y-') || '13-40 00:00:00'
         WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.250'
         WHEN 4 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS form FROM orders) GROUP BY ALL""",
)
oracle(
    "zip_check",
    """SELECT zip, coalesce(NOT regexp_full_match(zip, '[0-9]{5}'), false) AS bad, count(*) AS row_count
       FROM (SELECT customer_zip_code_prefix AS zip FROM clean_customers
             UNION ALL SELECT seller_zip_code_prefix FROM clean_sellers) GROUP BY ALL""",
)
oracle("seller_state_code", "SELECT seller_id, seller_state FROM clean_sellers")
oracle(
    "delivery_days",
    f"""SELECT order_id, load_id, {DELIVERY_DAYS} AS delivery_days, {DELAY_DAYS} AS delivery_delay_days
       FROM clean_orders""",
)
oracle("delivery_status", f"SELECT order_id, load_id, {STATUS} AS delivery_status FROM clean_orders")
oracle(
    "date_key", f"SELECT order_id, load_id, {datekey('order_purchase_timestamp')} AS order_date_key FROM clean_orders"
)
oracle("dedup_orders", f"SELECT {', '.join(ORDER_COLUMNS)}, load_id, source_file FROM newest_orders")
oracle("dedup_order_items", f"SELECT {', '.join(ITEM_COLUMNS)}, load_id, source_file FROM newest_order_items")
oracle(
    "dq_counts",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, count(*) AS rows_total,
            count(*) FILTER (data_quality_status = 'CHECK') AS rows_check,
            count(*) FILTER (data_quality_status = 'REJECTED') AS rows_rejected FROM judged_{n}"""
        for n in [*TABLES, "delivery"]
    ),
)
oracle("inc_new_rows", "SELECT order_id, order_status, load_id FROM bronze_orders WHERE load_id > 1")
oracle(
    "inc_probe",
    "SELECT max(load_id) AS max_load_id, count(*) AS rows_extracted FROM bronze_order_items WHERE load_id > 1",
)
oracle(
    "inc_noop",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name, count(*) AS rows_stored, CAST(0 AS BIGINT) AS rows_extracted,
            CAST(0 AS BIGINT) AS rows_loaded, 'Success - No New Data' AS status FROM silver_{n}"""
        for n in ("orders", "order_items")
    ),
)
oracle("upsert_orders", "SELECT * FROM merged_orders")
oracle("upsert_order_items", "SELECT * FROM merged_order_items")
oracle(
    "load_metrics",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS table_name,
            (SELECT count(*) FROM merged_{n} WHERE change_type = 'updated') AS rows_updated,
            (SELECT count(*) FROM merged_{n} WHERE change_type = 'inserted') AS rows_inserted,
            (SELECT count(*) FROM merged_{n} WHERE change_type <> 'kept') AS rows_loaded,
            (SELECT count(*) FROM judged_{n}_2 WHERE data_quality_status = 'CHECK') AS rows_check,
            (SELECT count(*) FROM judged_{n}_2 WHERE data_quality_status = 'REJECTED') AS rows_rejected"""
        for n in ("orders", "order_items")
    ),
)
oracle("inc_two_batches", "SELECT * EXCLUDE (change_type) FROM merged_order_items")
oracle("inc_compaction", "SELECT * EXCLUDE (change_type) FROM merged_order_items")
oracle(
    "inc_pruned_merge",
    """SELECT s.source_load_id, s.rows_stored, c.rows_current FROM
       (SELECT source_load_id, count(*) AS rows_stored FROM (SELECT source_load_id FROM silver_order_items_1
        UNION ALL SELECT source_load_id FROM silver_order_items_2) GROUP BY ALL) s
       LEFT JOIN (SELECT source_load_id, count(*) AS rows_current FROM merged_order_items GROUP BY ALL) c
       ON s.source_load_id = c.source_load_id""",
)
PIECES["sales_first"] = PIECES["sales_source"].replace("silver_order_items", "silver_order_items_1")
PIECES["sales_merged"] = PIECES["sales_source"].replace("silver_order_items", "merged_order_items")
oracle(
    "inc_fact_delta",
    """SELECT order_id, order_item_id, price FROM sales_first
       UNION ALL SELECT m.order_id, m.order_item_id, m.price FROM sales_merged m
       ANTI JOIN sales_first f ON m.order_id = f.order_id AND m.order_item_id = f.order_item_id""",
)
oracle("fact_refresh", "SELECT order_id, order_item_id, price FROM sales_merged")
oracle(
    "inc_late_batch",
    "SELECT order_id, order_item_id, price, source_load_id, change_type FROM late_order_items",
)
oracle(
    "batch_idempotent",
    """SELECT 'orders_1' AS source_batch_key, 'orders_1.csv' AS source_name, 'Success' AS status,
       count(*) AS rows_loaded, count(*) AS rows_stored, CAST(1 AS INTEGER) AS times_refused
       FROM bronze_orders WHERE load_id = 1""",
)
oracle(
    "run_log",
    " UNION ALL ".join(
        f"""SELECT 'silver_{n}' AS pipeline_name, 'Success' AS status,
            (SELECT count(*) FROM {'silver_orders' if n == 'delivery' else 'bronze_' + n}) AS rows_extracted,
            (SELECT count(*) FROM silver_{n}) AS rows_loaded,
            (SELECT count(*) FROM judged_{n} WHERE data_quality_status = 'REJECTED') AS rows_rejected"""
        for n in [*TABLES, "delivery"]
    ),
)
oracle("lookup_translation", "SELECT * FROM category_names")
oracle("dim_customer_latest", "SELECT customer_unique_id, customer_id FROM customer_source")
oracle("dim_customer", "SELECT * FROM customer_source")
oracle("dim_customer_delta", "SELECT * FROM customer_source")
oracle("dim_product", "SELECT * FROM product_source")
oracle("dim_seller", "SELECT * FROM seller_source")
oracle("dim_date", "SELECT * FROM dim_date")
oracle(
    "dim_surrogate_keys",
    """SELECT 'dim_customer' AS dimension, customer_unique_id AS natural_key, customer_key AS surrogate_key
       FROM dim_customer
       UNION ALL SELECT 'dim_product', product_id, product_key FROM dim_product
       UNION ALL SELECT 'dim_seller', seller_id, seller_key FROM dim_seller""",
)
PIECES["valid_customers"] = "SELECT * FROM silver_customers WHERE data_quality_status = 'VALID'"
PIECES["valid_source"] = customers_of("valid_customers")
PIECES["dim_before"] = numbered("valid_source", ["customer_unique_id"], "customer_key", "BIGINT")
PIECES["dim_added"] = numbered(
    "(SELECT * FROM customer_source ANTI JOIN dim_before USING (customer_unique_id))",
    ["customer_unique_id"], "customer_key", "BIGINT", "(SELECT max(customer_key) FROM dim_before)",
)
oracle(
    "scd1_customer",
    """SELECT b.customer_key, s.*, 'updated' AS change_type
       FROM customer_source s JOIN (SELECT customer_key, customer_unique_id FROM dim_before) b USING (customer_unique_id)
       UNION ALL BY NAME SELECT *, 'inserted' AS change_type FROM dim_added""",
)
oracle(
    "anti_new_customers",
    """SELECT customer_id, data_quality_reason FROM silver_customers s
       WHERE NOT EXISTS (SELECT 1 FROM valid_customers v WHERE v.customer_id = s.customer_id)""",
)
oracle(
    "anti_new_items",
    """SELECT order_id, order_item_id, price FROM silver_order_items_2 s
       WHERE NOT EXISTS (SELECT 1 FROM silver_order_items_1 t
                         WHERE t.order_id = s.order_id AND t.order_item_id = s.order_item_id)""",
)
oracle(
    "join_fact_delivery",
    """SELECT d.order_id, d.customer_id, k.customer_key FROM silver_delivery d
       JOIN silver_customers c ON d.customer_id = c.customer_id
       JOIN dim_customer k ON c.customer_unique_id = k.customer_unique_id""",
)
oracle("fact_sales", "SELECT * FROM sales_source")
oracle("fact_payments", "SELECT * FROM payments_source")
oracle("fact_delivery", "SELECT * FROM delivery_source")
oracle(
    "fact_rejects",
    """SELECT * FROM (
       SELECT 'fact_sales' AS table_name,
         CASE WHEN k.customer_key IS NULL THEN 'No order or customer' WHEN p.product_key IS NULL THEN 'No product'
              WHEN s.seller_key IS NULL THEN 'No seller' ELSE 'No purchase date' END AS reject_reason,
         count(*) AS row_count
       FROM silver_order_items i LEFT JOIN order_keys k USING (order_id) LEFT JOIN dim_product p USING (product_id)
       LEFT JOIN dim_seller s USING (seller_id)
       WHERE NOT EXISTS (SELECT 1 FROM fact_sales f WHERE f.order_id = i.order_id AND f.order_item_id = i.order_item_id)
       GROUP BY ALL
       UNION ALL
       SELECT 'fact_payments', CASE WHEN k.customer_key IS NULL THEN 'No order or customer' ELSE 'No purchase date' END,
         count(*)
       FROM silver_order_payments i LEFT JOIN order_keys k USING (order_id)
       WHERE NOT EXISTS (SELECT 1 FROM fact_payments f
                         WHERE f.order_id = i.order_id AND f.payment_sequential = i.payment_sequential)
       GROUP BY ALL
       UNION ALL
       SELECT 'fact_delivery', 'No customer', count(*) FROM silver_delivery i
       WHERE NOT EXISTS (SELECT 1 FROM fact_delivery f WHERE f.order_id = i.order_id) GROUP BY ALL)""",
)
oracle(
    "fact_keys",
    """SELECT sales_key, order_id, order_item_id, price, CAST(order_date_key // 100 AS INTEGER) AS order_month
       FROM fact_sales""",
)
oracle(
    "fact_idempotent",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS fact_table, count(*) AS rows_stored, count(*) AS rows_extracted,
            CAST(0 AS BIGINT) AS rows_loaded FROM {n}"""
        for n in ("fact_sales", "fact_payments", "fact_delivery")
    ),
)
oracle(
    "contract_null_key",
    """SELECT 'dim_customer' AS dimension_name, count(*) AS rows_rejected FROM judged_customers
       WHERE customer_unique_id IS NULL
       UNION ALL SELECT 'dim_product', count(*) FROM judged_products WHERE product_id IS NULL
       UNION ALL SELECT 'dim_seller', count(*) FROM judged_sellers WHERE seller_id IS NULL""",
)
# every row without a complete key is kept, not only the latest of them
PIECES["stored_order_items"] = f"""
SELECT * FROM newest_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL
UNION ALL SELECT * FROM clean_order_items WHERE order_id IS NULL OR order_item_id IS NULL"""
oracle(
    "quarantine_rows",
    f"""SELECT order_id, order_item_id, product_id, price, data_quality_reason, source_file
        FROM (SELECT *, {verdict(ITEM_RULES)} FROM stored_order_items) WHERE data_quality_status = 'REJECTED'""",
)
oracle(
    "quarantine_orders",
    """SELECT customer_id, order_status, 'Missing order_id' AS data_quality_reason, source_file
       FROM clean_orders WHERE order_id IS NULL""",
)

# --- validation -------------------------------------------------------------------------------

LABELS = {
    "DimCustomer": "dim_customer", "DimProduct": "dim_product", "DimSeller": "dim_seller", "DimDate": "dim_date",
    "FactSales": "fact_sales", "FactPayments": "fact_payments", "FactDelivery": "fact_delivery",
}
oracle(
    "val_row_counts",
    " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) AS row_count FROM {v}" for k, v in LABELS.items()),
)
oracle(
    "val_control_totals",
    """SELECT 'Silver Order Items' AS source_table, count(*) AS row_count, CAST(sum(price) AS DECIMAL(38,2)) AS total_price,
       CAST(sum(freight_value) AS DECIMAL(38,2)) AS total_freight FROM silver_order_items
       UNION ALL SELECT 'Gold FactSales', count(*), sum(price), sum(freight_value) FROM fact_sales
       UNION ALL SELECT 'Silver Payments', count(*), sum(payment_value), NULL FROM silver_order_payments
       UNION ALL SELECT 'Gold FactPayments', count(*), sum(payment_value), NULL FROM fact_payments""",
)
oracle(
    "val_delivery_totals",
    """SELECT 'Silver Delivery' AS source_table, count(*) AS row_count,
       CAST(sum(delivery_days) AS BIGINT) AS total_delivery_days,
       CAST(sum(delivery_delay_days) AS BIGINT) AS total_delay_days FROM silver_delivery
       UNION ALL SELECT 'Gold FactDelivery', count(*), CAST(sum(delivery_days) AS BIGINT),
       CAST(sum(delivery_delay_days) AS BIGINT) FROM fact_delivery""",
)


def orphans(label: str, fact: str, column: str, dim: str, key: str, optional: bool = False) -> str:
    extra = f" AND f.{column} IS NOT NULL" if optional else ""
    return (
        f"SELECT '{label}' AS check_name, count(*) AS invalid_rows FROM {fact} f LEFT JOIN {dim} d "
        f"ON f.{column} = d.{key} WHERE d.{key} IS NULL{extra}"
    )


oracle(
    "val_fk",
    " UNION ALL ".join(
        [
            orphans("FactSales - Customer", "fact_sales", "customer_key", "dim_customer", "customer_key"),
            orphans("FactSales - Product", "fact_sales", "product_key", "dim_product", "product_key"),
            orphans("FactSales - Seller", "fact_sales", "seller_key", "dim_seller", "seller_key"),
            orphans("FactSales - Date", "fact_sales", "order_date_key", "dim_date", "date_key"),
            orphans("FactPayments - Customer", "fact_payments", "customer_key", "dim_customer", "customer_key"),
            orphans("FactPayments - Date", "fact_payments", "order_date_key", "dim_date", "date_key"),
            orphans("FactDelivery - Customer", "fact_delivery", "customer_key", "dim_customer", "customer_key"),
        ]
    ),
)
oracle(
    "val_fk_role_dates",
    " UNION ALL ".join(
        orphans(f"FactDelivery - {label} Date", "fact_delivery", column, "dim_date", "date_key", True)
        for label, column in (
            ("Purchase", "purchase_date_key"), ("Delivered", "delivered_date_key"), ("Carrier", "carrier_date_key"),
            ("Estimated", "estimated_delivery_date_key"),
        )
    ),
)
oracle(
    "val_fact_grain",
    """SELECT 'FactSales' AS fact_table, count(*) AS total_rows,
       count(DISTINCT concat(order_id, '|', order_item_id)) AS distinct_grain FROM fact_sales
       UNION ALL SELECT 'FactPayments', count(*), count(DISTINCT concat(order_id, '|', payment_sequential))
       FROM fact_payments
       UNION ALL SELECT 'FactDelivery', count(*), count(DISTINCT order_id) FROM fact_delivery""",
)
oracle(
    "val_dim_unique",
    """SELECT 'DimCustomer' AS dimension_name, count(*) - count(DISTINCT customer_unique_id) AS duplicate_count
       FROM dim_customer
       UNION ALL SELECT 'DimProduct', count(*) - count(DISTINCT product_id) FROM dim_product
       UNION ALL SELECT 'DimSeller', count(*) - count(DISTINCT seller_id) FROM dim_seller""",
)
SUMMARY = {
    "Orders": "orders", "Order Items": "order_items", "Products": "products", "Customers": "customers",
    "Sellers": "sellers", "Payments": "order_payments", "Delivery": "delivery",
}
oracle(
    "val_dq_summary",
    " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, data_quality_status, count(*) AS row_count FROM silver_{n} GROUP BY ALL"
        for label, n in SUMMARY.items()
    ),
)

AUDITED = {f"silver_{n}": (n, "data_quality_status") for n in SUMMARY.values()} | {n: (n, "''") for n in ("fact_sales", "fact_payments", "fact_delivery")}
AUDITED_SUMS = {
    "order_items": ["price", "freight_value"], "order_payments": ["payment_value"], "delivery": ["delivery_days", "delivery_delay_days"],
    "fact_sales": ["price", "freight_value"], "fact_payments": ["payment_value"], "fact_delivery": ["delivery_days", "delivery_delay_days"],
}


def audited(piece: str, name: str, status: str, measure: str) -> str:
    value = f"CAST({'count(*)' if measure == 'rows' else f'sum({measure})'} AS DECIMAL(38,2))"
    return (
        f"SELECT '{name}' AS table_name, {status} AS status, '{measure}' AS measure, {value} AS state_value, {value} AS scan_value "
        f"FROM {piece} GROUP BY 1, 2"
    )


oracle(
    "val_state_audit",
    " UNION ALL ".join(audited(p, n, s, m) for p, (n, s) in AUDITED.items() for m in ["rows", *AUDITED_SUMS.get(n, [])]),
)


def repeated(label: str, source: str, keys: str) -> str:
    return (
        f"SELECT '{label}' AS contract, count(*) AS violations FROM "
        f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


SILVER_KEYS = {**{n: ", ".join(t[1]) for n, t in TABLES.items()}, "delivery": "order_id"}
GOLD_KEYS = {
    "dim_date": ("date_key", None), "dim_customer": ("customer_unique_id", "customer_key"),
    "dim_product": ("product_id", "product_key"), "dim_seller": ("seller_id", "seller_key"),
    "fact_sales": ("order_id, order_item_id", "sales_key"),
    "fact_payments": ("order_id, payment_sequential", "payment_key"), "fact_delivery": ("order_id", "delivery_key"),
}
oracle(
    "contract_unique",
    " UNION ALL ".join(
        [repeated(f"silver.{n}", f"silver_{n}", k) for n, k in SILVER_KEYS.items()]
        + [repeated(f"gold.{n}", n, k) for n, (k, _) in GOLD_KEYS.items()]
        + [repeated(f"gold.{n}.{s}", n, s) for n, (_, s) in GOLD_KEYS.items() if s]
    ),
)
_LINEAGE = ["data_quality_status", "source_load_id", "source_load_datetime", "source_file"]
NOT_NULL = {
    **{f"silver.{n}": (f"silver_{n}", [*k.split(", "), *_LINEAGE]) for n, k in SILVER_KEYS.items()},
    "gold.dim_date": (
        "dim_date",
        ["date_key", "full_date", "year", "quarter", "month", "month_name", "week_of_year", "day_of_month",
         "day_of_week", "day_name"],
    ),
    "gold.dim_customer": ("dim_customer", ["customer_key", "customer_unique_id", "customer_id"]),
    "gold.dim_product": ("dim_product", ["product_key", "product_id"]),
    "gold.dim_seller": ("dim_seller", ["seller_key", "seller_id"]),
    "gold.fact_sales": (
        "fact_sales",
        ["sales_key", "order_id", "order_item_id", "customer_key", "product_key", "seller_key", "order_date_key"],
    ),
    "gold.fact_payments": (
        "fact_payments", ["payment_key", "order_id", "payment_sequential", "customer_key", "order_date_key"],
    ),
    "gold.fact_delivery": ("fact_delivery", ["delivery_key", "order_id", "customer_key", "delivery_status"]),
}
NOT_NULL["silver.customers"][1].append("customer_unique_id")
NOT_NULL["silver.delivery"][1].append("delivery_status")
oracle(
    "contract_not_null",
    " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM {source}"
        for label, (source, columns) in NOT_NULL.items()
        for c in columns
    ),
)
#: Declared lengths of the text columns.
LENGTHS = (
    ("dim_date", "month_name", 20), ("dim_date", "day_name", 20),
    ("dim_customer", "customer_unique_id", 50), ("dim_customer", "customer_id", 50),
    ("dim_customer", "customer_zip_code_prefix", 5), ("dim_customer", "customer_city", 100),
    ("dim_customer", "customer_state", 2),
    ("dim_product", "product_id", 50), ("dim_product", "product_category_name", 255),
    ("dim_product", "product_category_name_english", 255),
    ("dim_seller", "seller_id", 50), ("dim_seller", "seller_zip_code_prefix", 5), ("dim_seller", "seller_city", 100),
    ("dim_seller", "seller_state", 2),
    ("fact_sales", "order_id", 50), ("fact_payments", "order_id", 50), ("fact_payments", "payment_type", 50),
    ("fact_delivery", "order_id", 50), ("fact_delivery", "delivery_status", 30),
)
oracle(
    "contract_length",
    " UNION ALL ".join(
        f"SELECT 'gold.{d}' AS table_name, '{c}' AS column_name, count(*) FILTER (length({c}) > {n}) AS long_rows FROM {d}"
        for d, c, n in LENGTHS
    ),
)

# --- marts ------------------------------------------------------------------------------------

TOTAL = "CAST(sum(price) AS DECIMAL(38,2)) AS total_sales"


def kpis(sales_where: str = "true", delivery_where: str = "true", customer_where: str = "true") -> str:
    return f"""
SELECT (SELECT CAST(sum(price) AS DECIMAL(38,2)) FROM fact_sales f JOIN dim_customer c USING (customer_key)
        WHERE {sales_where}) AS total_sales,
       (SELECT count(*) FROM fact_delivery JOIN dim_customer c USING (customer_key) WHERE {delivery_where}) AS total_orders,
       (SELECT count(*) FROM dim_product) AS total_products,
       (SELECT count(*) FROM dim_customer c WHERE {customer_where}) AS total_customers,
       (SELECT round(avg(delivery_days), 6) FROM fact_delivery JOIN dim_customer c USING (customer_key)
        WHERE {delivery_where}) AS avg_delivery_days"""


oracle("kpi_overview", kpis())
oracle(
    "kpi_overview_filtered",
    kpis(
        "order_date_key // 10000 = 1998 AND c.customer_state = 'AS'",
        "purchase_date_key // 10000 = 1998 AND c.customer_state = 'AS'",
        "c.customer_state = 'AS'",
    ),
)
TREND = f"""SELECT d.year, d.month, d.month_name, {TOTAL}, count(*) AS items_sold
FROM fact_sales f JOIN dim_date d ON f.order_date_key = d.date_key"""
oracle("sales_trend", f"{TREND} GROUP BY ALL")
oracle(
    "sales_trend_filtered",
    f"""{TREND} JOIN dim_customer c USING (customer_key) JOIN dim_product p USING (product_key)
        WHERE d.year = 1997 AND d.month = 3 AND c.customer_state = 'EU' AND p.product_category_name = 'PROMO'
        GROUP BY ALL""",
)
oracle("orders_by_status", "SELECT delivery_status, count(*) AS orders FROM fact_delivery GROUP BY ALL")
oracle(
    "top5_categories",
    f"""SELECT coalesce(product_category_name_english, product_category_name, 'Unknown') AS category, {TOTAL}
        FROM fact_sales JOIN dim_product USING (product_key) GROUP BY 1
        ORDER BY total_sales DESC NULLS LAST, category LIMIT 5""",
)
oracle(
    "top5_sellers",
    f"""SELECT seller_id, {TOTAL} FROM fact_sales JOIN dim_seller USING (seller_key) GROUP BY 1
        ORDER BY total_sales DESC NULLS LAST, seller_id LIMIT 5""",
)
oracle(
    "top5_cities",
    f"""SELECT customer_city, {TOTAL} FROM fact_sales JOIN dim_customer USING (customer_key) GROUP BY 1
        ORDER BY total_sales DESC NULLS LAST, customer_city NULLS LAST LIMIT 5""",
)
oracle(
    "payments_by_type",
    """SELECT payment_type, CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_value, count(*) AS payments
       FROM fact_payments GROUP BY ALL""",
)
oracle(
    "customers_by_state",
    """SELECT c.customer_state, count(DISTINCT c.customer_key) AS customers,
       CAST(sum(coalesce(o.n, 0)) AS BIGINT) AS orders, CAST(sum(s.total) AS DECIMAL(38,2)) AS total_sales
       FROM dim_customer c
       LEFT JOIN (SELECT customer_key, count(*) AS n FROM fact_delivery GROUP BY 1) o USING (customer_key)
       LEFT JOIN (SELECT customer_key, sum(price) AS total FROM fact_sales GROUP BY 1) s USING (customer_key)
       GROUP BY 1""",
)
oracle(
    "delivery_performance",
    """SELECT delivery_status, count(*) AS orders, round(avg(delivery_days), 6) AS avg_delivery_days,
       round(avg(delivery_delay_days), 6) AS avg_delay_days,
       round(count(*) / sum(count(*)) OVER (), 6) AS share_of_delivered
       FROM fact_delivery WHERE delivery_status <> 'Not Delivered' GROUP BY 1""",
)

# --- marts under slicers ----------------------------------------------------------------------

oracle(
    "orders_by_status_filtered",
    """SELECT delivery_status, count(*) AS orders FROM fact_delivery JOIN dim_customer c USING (customer_key)
       WHERE purchase_date_key // 100 % 100 = 5 AND c.customer_state = 'EU' GROUP BY ALL""",
)
oracle(
    "top5_categories_filtered",
    f"""SELECT coalesce(product_category_name_english, product_category_name, 'Unknown') AS category, {TOTAL}
        FROM fact_sales JOIN dim_product p USING (product_key)
        WHERE order_date_key // 10000 = 1997 AND p.product_category_name = 'PROMO' GROUP BY 1
        ORDER BY total_sales DESC NULLS LAST, category LIMIT 5""",
)
oracle(
    "top5_sellers_filtered",
    f"""SELECT seller_id, {TOTAL} FROM fact_sales JOIN dim_seller USING (seller_key)
        WHERE order_date_key // 100 % 100 = 5 GROUP BY 1 ORDER BY total_sales DESC NULLS LAST, seller_id LIMIT 5""",
)
oracle(
    "top5_cities_filtered",
    f"""SELECT customer_city, {TOTAL} FROM fact_sales JOIN dim_customer c USING (customer_key)
        WHERE c.customer_state = 'AS' GROUP BY 1 ORDER BY total_sales DESC NULLS LAST, customer_city NULLS LAST LIMIT 5""",
)
oracle(
    "payments_by_type_filtered",
    """SELECT payment_type, CAST(sum(payment_value) AS DECIMAL(38,2)) AS total_value, count(*) AS payments
       FROM fact_payments JOIN dim_customer c USING (customer_key)
       WHERE order_date_key // 10000 = 1996 AND c.customer_state = 'AF' GROUP BY ALL""",
)
oracle(
    "customers_by_state_filtered",
    """SELECT c.customer_state, count(DISTINCT c.customer_key) AS customers,
       CAST(sum(coalesce(o.n, 0)) AS BIGINT) AS orders, CAST(sum(s.total) AS DECIMAL(38,2)) AS total_sales
       FROM dim_customer c
       LEFT JOIN (SELECT customer_key, count(*) AS n FROM fact_delivery WHERE purchase_date_key // 10000 = 1997 GROUP BY 1) o
         USING (customer_key)
       LEFT JOIN (SELECT customer_key, sum(price) AS total FROM fact_sales WHERE order_date_key // 10000 = 1997 GROUP BY 1) s
         USING (customer_key)
       WHERE c.customer_state IN ('AS') GROUP BY 1""",
)
oracle(
    "delivery_performance_filtered",
    """SELECT delivery_status, count(*) AS orders, round(avg(delivery_days), 6) AS avg_delivery_days,
       round(avg(delivery_delay_days), 6) AS avg_delay_days,
       round(count(*) / sum(count(*)) OVER (), 6) AS share_of_delivered
       FROM fact_delivery WHERE delivery_status <> 'Not Delivered' AND purchase_date_key // 100 = 199705 GROUP BY 1""",
)
