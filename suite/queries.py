"""One query per operator of the inventory: (spark, sf_dir) to a DataFrame.

Column, rule and merge operators run on the bronze projections directly. Star, validation and
mart queries read the stored warehouse, as they would in use.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.convert import to_decimal, to_int, to_timestamp_ntz
from stratamart.functions.dates import date_key, days_between, delivery_status
from stratamart.functions.text import bad_zip, clean, state_code
from stratamart.operators import checks
from stratamart.operators.increments import new_rows, probe, rows_of_loads
from stratamart.operators.keys import assign_keys
from stratamart.operators.rules import CHECK, REJECTED, VALID
from stratamart.operators.upsert import change_counts, changes, insert_absent, upsert
from stratamart.plans import gold, marts, silver, validation
from stratamart.plans.warehouse import side_by_side
from stratamart.schemas import BRONZE, SILVER
from stratamart.session import new_folder
from stratamart.sources.ledger import BatchAlreadyLoaded
from stratamart.sources.raw import EmptySource, read_raw, stamp
from suite import fixtures
from suite.loaded import deliver, empty_warehouse, load_time, loaded_warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def judged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """All judged rows of one table, built straight from its bronze projection."""
    if name == "delivery":
        return silver.build_delivery(accepted(spark, sf_dir, "orders"))
    return silver.build(fixtures.bronze(spark, sf_dir, name), name)


def accepted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver.accepted(judged(spark, sf_dir, name))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a written table, for plans that read them more than once."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def of_load(spark: SparkSession, sf_dir: str, name: str, load: int) -> DataFrame:
    """Judged rows of one load alone."""
    rows = rows_of_loads(fixtures.bronze(spark, sf_dir, name), [load])
    return silver.build(rows, name)


# --- sources ----------------------------------------------------------------------------------


def _header(name: str) -> str:
    return ",".join(BRONZE[name])


@query
def src_csv_bronze(spark, sf_dir):
    """Write the orders as quoted CSV, load the files through the bronze job, read and clean them."""
    folder = new_folder(spark, "csv")
    rows = fixtures.bronze(spark, sf_dir, "orders").select(*BRONZE["orders"])
    rows.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(folder)
    warehouse = empty_warehouse(spark)
    warehouse.load_bronze("orders", folder, "orders_all", "orders.csv")
    return silver.cleaned(warehouse.bronze("orders"), "orders").select(*SILVER["orders"].columns)


@query
def src_csv_raw_split(spark, sf_dir):
    """Write the sellers as plain lines and split them at every comma; the state takes the rest."""
    folder = new_folder(spark, "lines")
    rows = fixtures.bronze(spark, sf_dir, "sellers")
    line = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in BRONZE["sellers"]])
    rows.select(line.alias(_header("sellers"))).write.options(header=True, sep="\x01", quote="").csv(folder)
    raw = read_raw(spark, "sellers", folder, mode="split")
    return silver.cleaned(stamp(raw, 1, load_time(1), "sellers_1.csv"), "sellers").select(*SILVER["sellers"].columns)


@query
def src_csv_malformed(spark, sf_dir):
    """Write the sellers as plain lines, a field short or with commas in one, and load them as quoted CSV: no row is lost."""
    folder = new_folder(spark, "lines")
    rows = fixtures.bronze(spark, sf_dir, "sellers")
    number = F.regexp_replace("seller_id", '"', "").cast("bigint")
    every = [F.coalesce(c, F.lit("")) for c in BRONZE["sellers"]]
    short = (number % 7 == 0) & (number % 10 != 0)
    line = F.when(short, F.concat_ws(",", *every[:-1])).otherwise(F.concat_ws(",", *every))
    rows.select(line.alias(_header("sellers"))).write.options(header=True, sep="\x01", quote="").csv(folder)
    warehouse = empty_warehouse(spark)
    loaded = warehouse.load_bronze("sellers", folder, "sellers_odd", "sellers.csv")
    surplus = F.count_if(F.size(F.split("malformed_line", ",")) > len(BRONZE["sellers"])).alias("rows_with_surplus")
    return warehouse.malformed("sellers").agg(
        F.lit(loaded["rows_loaded"]).cast("bigint").alias("rows_loaded"), F.count("*").alias("rows_malformed"), surplus
    )


@query
def src_csv_multiline(spark, sf_dir):
    """Write whole document texts as review messages, commas, quotes and line breaks included, and read them back."""
    folder = new_folder(spark, "reviews")
    documents = fixtures.table(spark, sf_dir, "documents")
    rows = documents.select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("n_chars").cast("string").alias("order_id"),
        F.lit("5").alias("review_score"),
        F.col("source").alias("review_comment_title"),
        F.col("text").alias("review_comment_message"),
        F.lit("2018-01-01 00:00:00").alias("review_creation_date"),
        F.lit("2018-01-02 00:00:00").alias("review_answer_timestamp"),
    )
    rows.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(folder)
    read = read_raw(spark, "order_reviews", folder, mode="multiline")
    return read.select(
        "review_id",
        "review_comment_title",
        F.length("review_comment_message").cast("bigint").alias("message_length"),
        F.md5("review_comment_message").alias("message_digest"),
        "review_answer_timestamp",
    )


@query
def src_bronze_generic(spark, sf_dir):
    """Row counts of the bronze tables, all loaded by the one generic job."""
    warehouse = loaded_warehouse(spark, sf_dir)
    return checks.check_rows({name: warehouse.bronze(name) for name in fixtures.INPUTS})


@query
def src_bronze_stamp(spark, sf_dir):
    """Load metadata as stamped on the stored rows."""
    bronze = loaded_warehouse(spark, sf_dir).bronze("orders")
    return bronze.groupBy("load_datetime", "source_file").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("load_id").alias("load_ids")
    )


@query
def src_empty_guard(spark, sf_dir):
    """A delivery without rows fails and is logged as Failed; the one before it stays."""
    warehouse = empty_warehouse(spark)
    rows = fixtures.bronze(spark, sf_dir, "orders")
    warehouse.load_bronze_rows("orders", rows, "full", "orders.csv")
    folder = new_folder(spark, "empty")
    none = new_rows(rows, max(fixtures.LOADS.values())).select(*BRONZE["orders"])
    none.write.options(header=True).csv(folder)
    try:
        warehouse.load_bronze("orders", folder, "empty", "empty.csv")
    except EmptySource:
        pass
    visible = warehouse.bronze("orders").agg(F.count(F.lit(1)).alias("rows_visible"))
    states = warehouse.ledger.batches().select("source_batch_key", "status", "rows_loaded")
    return states.join(
        visible.select(F.lit("full").alias("source_batch_key"), "rows_visible"), "source_batch_key", "left"
    )


# --- projections, filters ---------------------------------------------------------------------


@query
def proj_rename(spark, sf_dir):
    rows = silver.cleaned(fixtures.bronze(spark, sf_dir, "products"), "products")
    return rows.select(
        "product_id", "product_name_length", "product_description_length", F.col("load_id").alias("source_load_id")
    )


@query
def filter_not_rejected(spark, sf_dir):
    rows = judged(spark, sf_dir, "order_items").where(F.col("data_quality_status") != REJECTED)
    return rows.select("order_id", "order_item_id", "data_quality_status")


@query
def filter_status_in(spark, sf_dir):
    rows = judged(spark, sf_dir, "order_payments").where(F.col("data_quality_status").isin(VALID, CHECK))
    return rows.select("order_id", "payment_sequential", "data_quality_status")


# --- scalar functions -------------------------------------------------------------------------


@query
def clean_text(spark, sf_dir):
    return fixtures.bronze(spark, sf_dir, "customers").select(
        clean("customer_id").alias("customer_id"),
        clean("customer_unique_id").alias("customer_unique_id"),
        clean("customer_city", "lower").alias("customer_city"),
        clean("customer_state", "upper").alias("customer_state"),
    )


@query
def conv_int(spark, sf_dir):
    line = fixtures.table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber").cast("string")
    text = (
        F.when(F.col("l_partkey") % 7 == 0, F.col("l_quantity").cast("string"))
        .when(F.col("l_partkey") % 7 == 1, F.concat(F.lit("+"), n))
        .when(F.col("l_partkey") % 7 == 2, F.concat(F.lit("-"), n))
        .when(F.col("l_partkey") % 7 == 3, F.concat(n, F.lit("e2")))
        .when(F.col("l_partkey") % 7 == 4, F.concat(n, F.lit("0000000000")))
        .when(F.col("l_partkey") % 7 == 5, F.concat(n, F.lit(" ")))
        .otherwise(n)
    )
    forms = line.select(text.alias("form"))
    return forms.groupBy("form", to_int(F.col("form")).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def conv_decimal(spark, sf_dir):
    line = fixtures.table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber").cast("string")
    eighths = (F.col("l_quantity") / 8).cast("string")
    text = (
        F.when(F.col("l_partkey") % 7 == 0, F.concat(n, F.lit("e3")))
        .when(F.col("l_partkey") % 7 == 1, F.concat(F.lit("-"), eighths))
        .when(F.col("l_partkey") % 7 == 2, F.concat(F.lit("."), n))
        .when(F.col("l_partkey") % 7 == 3, F.concat(n, F.lit(".")))
        .when(F.col("l_partkey") % 7 == 4, F.concat(n, F.lit(",50")))
        .when(F.col("l_partkey") % 7 == 5, F.concat(n, F.lit("000000000000000000")))
        .otherwise(eighths)
    )
    forms = line.select(text.alias("form"))
    return forms.groupBy("form", to_decimal(F.col("form")).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


@query
def conv_timestamp(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    moment = F.col("o_orderdate").cast("string")
    text = (
        F.when(F.col("o_orderkey") % 6 == 0, F.substring(moment, 1, 10))
        .when(F.col("o_orderkey") % 6 == 1, F.substring(moment, 1, 4))
        .when(F.col("o_orderkey") % 6 == 2, F.concat(F.substring(moment, 1, 5), F.lit("13-40 00:00:00")))
        .when(F.col("o_orderkey") % 6 == 3, F.concat(moment, F.lit(".250")))
        .when(F.col("o_orderkey") % 6 == 4, F.replace(moment, F.lit("-"), F.lit("/")))
        .otherwise(moment)
    )
    forms = orders.select(text.alias("form"))
    return forms.groupBy("form", to_timestamp_ntz(F.col("form")).alias("value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def zip_check(spark, sf_dir):
    zips = fixtures.bronze(spark, sf_dir, "customers").select(clean("customer_zip_code_prefix").alias("zip")).unionByName(
        fixtures.bronze(spark, sf_dir, "sellers").select(clean("seller_zip_code_prefix").alias("zip"))
    )
    return zips.groupBy("zip", F.coalesce(bad_zip(F.col("zip")), F.lit(False)).alias("bad")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query
def seller_state_code(spark, sf_dir):
    return fixtures.bronze(spark, sf_dir, "sellers").select(
        clean("seller_id").alias("seller_id"), state_code(clean("seller_state", "upper")).alias("seller_state")
    )


def _cleaned_orders(spark, sf_dir):
    return silver.cleaned(fixtures.bronze(spark, sf_dir, "orders"), "orders")


@query
def delivery_days(spark, sf_dir):
    orders = _cleaned_orders(spark, sf_dir)
    bought, delivered = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    return orders.select(
        "order_id",
        "load_id",
        days_between(bought, delivered).alias("delivery_days"),
        days_between(estimated, delivered).alias("delivery_delay_days"),
    )


@query
def delivery_status_text(spark, sf_dir):
    orders = _cleaned_orders(spark, sf_dir)
    status = delivery_status(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return orders.select("order_id", "load_id", status.alias("delivery_status"))


QUERIES["delivery_status"] = QUERIES.pop("delivery_status_text")


@query
def date_keys(spark, sf_dir):
    return _cleaned_orders(spark, sf_dir).select(
        "order_id", "load_id", date_key(F.col("order_purchase_timestamp")).alias("order_date_key")
    )


QUERIES["date_key"] = QUERIES.pop("date_keys")


# --- latest version, rules --------------------------------------------------------------------


@query
def dedup_orders(spark, sf_dir):
    rows = silver.newest(_cleaned_orders(spark, sf_dir), "orders")
    return rows.select(*SILVER["orders"].columns, "load_id", "source_file")


@query
def dedup_order_items(spark, sf_dir):
    rows = silver.newest(silver.cleaned(fixtures.bronze(spark, sf_dir, "order_items"), "order_items"), "order_items")
    return rows.select(*SILVER["order_items"].columns, "load_id", "source_file")


def _rules_query(name: str) -> Query:
    def run(spark, sf_dir):
        return judged(spark, sf_dir, name).select(*SILVER[name].keys, "data_quality_status", "data_quality_reason")

    return run


def _silver_query(name: str) -> Query:
    def run(spark, sf_dir):
        return accepted(spark, sf_dir, name)

    return run


for _key, _name in {
    "orders": "orders",
    "order_items": "order_items",
    "payments": "order_payments",
    "customers": "customers",
    "sellers": "sellers",
    "products": "products",
    "delivery": "delivery",
}.items():
    QUERIES[f"dq_{_key}"] = _rules_query(_name)
    QUERIES[f"silver_{_key}"] = _silver_query(_name)


@query
def dq_counts(spark, sf_dir):
    """Total, CHECK and REJECTED rows of each table, in one pass per table."""
    status = F.col("data_quality_status")
    return checks.stack(
        [
            judged(spark, sf_dir, name)
            .agg(
                F.count(F.lit(1)).alias("rows_total"),
                F.count_if(status == CHECK).alias("rows_check"),
                F.count_if(status == REJECTED).alias("rows_rejected"),
            )
            .select(F.lit(name).alias("table_name"), "rows_total", "rows_check", "rows_rejected")
            for name in ("orders", "order_items", "order_payments", "customers", "sellers", "products", "delivery")
        ]
    )


# --- incremental loads ------------------------------------------------------------------------


@query
def inc_new_rows(spark, sf_dir):
    return new_rows(fixtures.bronze(spark, sf_dir, "orders"), 1).select("order_id", "order_status", "load_id")


@query
def inc_probe(spark, sf_dir):
    return probe(new_rows(fixtures.bronze(spark, sf_dir, "order_items"), 1))


@query
def inc_noop(spark, sf_dir):
    """Loading again without new rows: counts are 0 and the stored rows stay."""
    warehouse = loaded_warehouse(spark, sf_dir)
    names = ("orders", "order_items")
    again = {name: warehouse.load_silver(name) for name in names}
    return checks.stack(
        [
            warehouse.silver(name).agg(F.count(F.lit(1)).alias("rows_stored")).select(
                F.lit(name).alias("table_name"),
                "rows_stored",
                F.lit(again[name]["rows_extracted"]).cast("bigint").alias("rows_extracted"),
                F.lit(again[name]["rows_loaded"]).cast("bigint").alias("rows_loaded"),
                F.lit(again[name]["status"]).alias("status"),
            )
            for name in names
        ]
    )


def _second_load(spark, sf_dir, name: str) -> DataFrame:
    """Load 2 merged into the result of load 1."""
    first = silver.accepted(of_load(spark, sf_dir, name, 1))
    second = silver.accepted(of_load(spark, sf_dir, name, 2))
    return upsert(first, second, SILVER[name].keys, newer="source_load_id")


@query
def upsert_orders(spark, sf_dir):
    return _second_load(spark, sf_dir, "orders")


@query
def upsert_order_items(spark, sf_dir):
    return _second_load(spark, sf_dir, "order_items")


@query
def load_metrics(spark, sf_dir):
    """Counts of the second load of each table that has two."""
    rows = []
    for name in ("orders", "order_items"):
        status = F.col("data_quality_status")
        second = stored(of_load(spark, sf_dir, name, 2), "second-load")
        verdicts = second.agg(
            F.count_if(status == CHECK).alias("rows_check"), F.count_if(status == REJECTED).alias("rows_rejected")
        )
        first = silver.accepted(of_load(spark, sf_dir, name, 1))
        changed = change_counts(changes(first, silver.accepted(second), SILVER[name].keys, newer="source_load_id"))
        both = changed.withColumn("table_name", F.lit(name)).join(
            verdicts.withColumn("table_name", F.lit(name)), "table_name"
        )
        rows.append(both.select("table_name", *[c for c in both.columns if c != "table_name"]))
    return checks.stack(rows)


@query
def inc_two_batches(spark, sf_dir):
    """Two stored increments of the order items, silver loaded after each."""
    return _two_item_loads(spark, sf_dir).silver("order_items")


def _load_items(warehouse, sf_dir, load: int) -> None:
    part = rows_of_loads(fixtures.bronze(warehouse.spark, sf_dir, "order_items"), [load])
    warehouse.load_bronze_rows("order_items", part, f"items_{load}", f"order_items_{load}.csv", load_time(load))


def _two_item_loads(spark, sf_dir):
    warehouse = empty_warehouse(spark)
    for load in (1, 2):
        _load_items(warehouse, sf_dir, load)
        warehouse.load_silver("order_items")
    return warehouse


@query
def inc_compaction(spark, sf_dir):
    """The same two increments, folded into one version: the rows stay."""
    warehouse = _two_item_loads(spark, sf_dir)
    warehouse.compact_silver("order_items")
    return warehouse.silver("order_items")


@query
def inc_pruned_merge(spark, sf_dir):
    """The same two increments by load: rows that were stored, and rows that no later load replaced."""
    warehouse = _two_item_loads(spark, sf_dir)
    versions = warehouse.ledger.commits("silver_order_items")
    kept = silver.accepted(warehouse._versions("silver", "order_items").stored(versions))
    stored_rows = kept.groupBy("source_load_id").agg(F.count(F.lit(1)).alias("rows_stored"))
    current = warehouse.silver("order_items").groupBy("source_load_id").agg(F.count(F.lit(1)).alias("rows_current"))
    return stored_rows.join(current, "source_load_id", "left")


def _star_of_first_items(spark, sf_dir):
    """A warehouse with everything but the second delivery of the items, which follows."""
    warehouse = empty_warehouse(spark)
    others = [name for name in fixtures.INPUTS if name not in ("order_items", "order_reviews", "geolocation")]
    side_by_side({name: partial(deliver, warehouse, sf_dir, name) for name in others})
    _load_items(warehouse, sf_dir, 1)
    warehouse.refresh()
    _load_items(warehouse, sf_dir, 2)
    warehouse.load_silver("order_items")
    return warehouse


@query
def inc_fact_delta(spark, sf_dir):
    """Sales after a second delivery of items: new ones are added, sold ones keep their values."""
    warehouse = _star_of_first_items(spark, sf_dir)
    warehouse.load_fact("fact_sales")
    return warehouse.gold("fact_sales").select("order_id", "order_item_id", "price")


@query
def fact_refresh(spark, sf_dir):
    """The same, with the fact rebuilt: corrected prices arrive."""
    warehouse = _star_of_first_items(spark, sf_dir)
    warehouse.load_fact("fact_sales", refresh=True)
    return warehouse.gold("fact_sales").select("order_id", "order_item_id", "price")


@query
def inc_late_batch(spark, sf_dir):
    """Load 2 was processed first; load 1 comes late, fills gaps and replaces nothing."""
    done = silver.accepted(of_load(spark, sf_dir, "order_items", 2))
    late = silver.accepted(of_load(spark, sf_dir, "order_items", 1))
    merged = upsert(done, late, SILVER["order_items"].keys, newer="source_load_id")
    return merged.select("order_id", "order_item_id", "price", "source_load_id", "change_type")


@query
def batch_idempotent(spark, sf_dir):
    """The same batch key twice: the second attempt is refused and the ledger stays as it was."""
    warehouse = empty_warehouse(spark)
    rows = rows_of_loads(fixtures.bronze(spark, sf_dir, "orders"), [1])
    warehouse.load_bronze_rows("orders", rows, "orders_1", "orders_1.csv", load_time(1))
    refused = 0
    try:
        warehouse.load_bronze_rows("orders", rows, "orders_1", "orders_1.csv", load_time(1))
    except BatchAlreadyLoaded:
        refused = 1
    stored = warehouse.bronze("orders").agg(F.count(F.lit(1)).alias("rows_stored"))
    ledger = warehouse.ledger.batches().select("source_batch_key", "source_name", "status", "rows_loaded")
    return ledger.join(stored.withColumn("source_batch_key", F.lit("orders_1")), "source_batch_key").withColumn(
        "times_refused", F.lit(refused)
    )


@query
def run_log(spark, sf_dir):
    """First run of every silver table, as the run log has it."""
    runs = loaded_warehouse(spark, sf_dir).ledger.runs()
    first = runs.where(F.col("pipeline_name").startswith("silver_")).groupBy("pipeline_name").agg(
        F.min_by(F.struct("status", "rows_extracted", "rows_loaded", "rows_rejected"), "seq").alias("run")
    )
    return first.select("pipeline_name", "run.*")


# --- dimensions and facts ---------------------------------------------------------------------


@query
def lookup_translation(spark, sf_dir):
    return gold.category_lookup(fixtures.bronze(spark, sf_dir, "category_translation"))


@query
def dim_customer_latest(spark, sf_dir):
    """The customer_id that stands for each unique customer."""
    rows = gold.customer_source(accepted(spark, sf_dir, "customers"), accepted(spark, sf_dir, "orders"))
    return rows.select("customer_unique_id", "customer_id")


@query
def dim_customer(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return warehouse.dim_source("dim_customer")


@query
def dim_product(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).dim_source("dim_product")


@query
def dim_seller(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).dim_source("dim_seller")


@query
def dim_date(spark, sf_dir):
    return gold.date_dim_of(loaded_warehouse(spark, sf_dir).silver("orders"))


@query
def dim_surrogate_keys(spark, sf_dir):
    """Keys of the stored dimensions: dense, starting at 1."""
    tables = loaded_warehouse(spark, sf_dir).gold_tables()
    named = {
        "dim_customer": ("customer_unique_id", "customer_key"),
        "dim_product": ("product_id", "product_key"),
        "dim_seller": ("seller_id", "seller_key"),
    }
    return checks.stack(
        [
            tables[name].select(
                F.lit(name).alias("dimension"), F.col(natural).alias("natural_key"), F.col(key).alias("surrogate_key")
            )
            for name, (natural, key) in named.items()
        ]
    )


@query
def scd1_customer(spark, sf_dir):
    """A dimension first loaded from VALID customers only, then from all of them."""
    warehouse = loaded_warehouse(spark, sf_dir)
    customers, orders = warehouse.silver("customers"), warehouse.silver("orders")
    before = gold.customer_source(customers.where(F.col("data_quality_status") == VALID), orders)
    target = assign_keys(stored(before, "scd1"), "customer_key", ["customer_unique_id"], 0, "bigint")
    merged = upsert(target, gold.customer_source(customers, orders), ["customer_unique_id"], carry="customer_key")
    merged = stored(merged, "scd1")
    last = merged.where("change_type <> 'inserted'").count()  # keys are dense
    fresh = assign_keys(merged.where(F.col("customer_key").isNull()), "customer_key", ["customer_unique_id"], last, "bigint")
    return merged.where(F.col("customer_key").isNotNull()).unionByName(fresh)


@query
def dim_customer_delta(spark, sf_dir):
    """The stored dimension after a second delivery of orders, of which only touched groups were ranked anew."""
    warehouse = empty_warehouse(spark)
    deliver(warehouse, sf_dir, "customers")
    warehouse.load_silver("customers")
    for load in (1, 2):
        part = rows_of_loads(fixtures.bronze(spark, sf_dir, "orders"), [load])
        warehouse.load_bronze_rows("orders", part, f"orders_{load}", f"orders_{load}.csv", load_time(load))
        warehouse.load_silver("orders")
        warehouse.load_dim("dim_customer")
    return warehouse.gold("dim_customer").drop("customer_key")


@query
def anti_new_customers(spark, sf_dir):
    customers = accepted(spark, sf_dir, "customers")
    known = customers.where(F.col("data_quality_status") == VALID)
    return insert_absent(known, customers, ["customer_id"]).select("customer_id", "data_quality_reason")


@query
def anti_new_items(spark, sf_dir):
    known = silver.accepted(of_load(spark, sf_dir, "order_items", 1))
    fresh = silver.accepted(of_load(spark, sf_dir, "order_items", 2))
    return insert_absent(known, fresh, ["order_id", "order_item_id"]).select("order_id", "order_item_id", "price")


@query
def join_fact_delivery(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    lookup = gold.customer_lookup(warehouse.silver("customers"), warehouse.gold("dim_customer"))
    return warehouse.silver("delivery").join(lookup, "customer_id").select("order_id", "customer_id", "customer_key")


def _lookup(warehouse):
    return gold.order_lookup(warehouse.silver("orders"), warehouse.silver("customers"), warehouse.gold("dim_customer"))


@query
def fact_sales(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return gold.loadable(
        gold.sales_candidates(
            warehouse.silver("order_items"),
            _lookup(warehouse),
            warehouse.gold("dim_product"),
            warehouse.gold("dim_seller"),
        )
    )


@query
def fact_payments(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return gold.loadable(gold.payment_candidates(warehouse.silver("order_payments"), _lookup(warehouse)))


@query
def fact_delivery(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return gold.loadable(
        gold.delivery_candidates(
            warehouse.silver("delivery"), warehouse.silver("customers"), warehouse.gold("dim_customer")
        )
    )


@query
def fact_rejects(spark, sf_dir):
    """Silver rows that no fact holds, by the key or date they lack."""
    warehouse = loaded_warehouse(spark, sf_dir)
    return checks.status_counts(
        {name: warehouse.fact_candidates(name) for name in ("fact_sales", "fact_payments", "fact_delivery")},
        by=gold.REASON,
    )


@query
def fact_keys(spark, sf_dir):
    """Stored sales with their surrogate key."""
    stored = loaded_warehouse(spark, sf_dir).gold("fact_sales")
    return stored.select("sales_key", "order_id", "order_item_id", "price", "order_month")


@query
def fact_idempotent(spark, sf_dir):
    """A repeated load inserts nothing."""
    warehouse = loaded_warehouse(spark, sf_dir)
    names = ("fact_sales", "fact_payments", "fact_delivery")
    again = side_by_side({name: partial(warehouse.load_fact, name) for name in names})
    return checks.stack(
        [
            warehouse.gold(name).agg(F.count(F.lit(1)).alias("rows_stored")).select(
                F.lit(name).alias("fact_table"),
                "rows_stored",
                F.lit(again[name]["rows_extracted"]).cast("bigint").alias("rows_extracted"),
                F.lit(again[name]["rows_loaded"]).cast("bigint").alias("rows_loaded"),
            )
            for name in names
        ]
    )


@query
def contract_null_key(spark, sf_dir):
    """Rows without a business key in what would feed each dimension before rejection."""
    sources = {
        "dim_customer": ("customers", "customer_unique_id"),
        "dim_product": ("products", "product_id"),
        "dim_seller": ("sellers", "seller_id"),
    }
    return checks.stack(
        [
            checks.null_keys(judged(spark, sf_dir, name), key).select(F.lit(dim).alias("dimension_name"), "rows_rejected")
            for dim, (name, key) in sources.items()
        ]
    )


@query
def quarantine_rows(spark, sf_dir):
    """Rejected rows stay traceable, with their reason."""
    warehouse = loaded_warehouse(spark, sf_dir)
    return warehouse.quarantine("order_items").select(
        "order_id", "order_item_id", "product_id", "price", "data_quality_reason", "source_file"
    )


@query
def quarantine_orders(spark, sf_dir):
    """Every order without an id is kept, not only the latest of them."""
    rows = loaded_warehouse(spark, sf_dir).quarantine("orders").where("order_id is null")
    return rows.select("customer_id", "order_status", "data_quality_reason", "source_file")


# --- validation -------------------------------------------------------------------------------


def _layers(spark, sf_dir):
    warehouse = loaded_warehouse(spark, sf_dir)
    return warehouse.silver_tables(), warehouse.gold_tables()


def _star(spark, sf_dir):
    return loaded_warehouse(spark, sf_dir).gold_tables()


QUERIES |= {
    "val_row_counts": lambda spark, sf_dir: validation.row_counts(_star(spark, sf_dir)),
    "val_control_totals": lambda spark, sf_dir: validation.control_totals(*_layers(spark, sf_dir)),
    "val_delivery_totals": lambda spark, sf_dir: validation.delivery_totals(*_layers(spark, sf_dir)),
    "val_fk": lambda spark, sf_dir: validation.foreign_keys(_star(spark, sf_dir)),
    "val_fk_role_dates": lambda spark, sf_dir: validation.delivery_dates(_star(spark, sf_dir)),
    "val_fact_grain": lambda spark, sf_dir: validation.fact_grain(_star(spark, sf_dir)),
    "val_dim_unique": lambda spark, sf_dir: validation.dimension_uniqueness(_star(spark, sf_dir)),
    "val_dq_summary": lambda spark, sf_dir: validation.quality_summary(_layers(spark, sf_dir)[0]),
    "val_state_audit": lambda spark, sf_dir: validation.state_audit(loaded_warehouse(spark, sf_dir).state(), *_layers(spark, sf_dir)),
    "contract_unique": lambda spark, sf_dir: validation.unique_contracts(*_layers(spark, sf_dir)),
    "contract_not_null": lambda spark, sf_dir: validation.not_null_contracts(*_layers(spark, sf_dir)),
    "contract_length": lambda spark, sf_dir: validation.length_contracts(_star(spark, sf_dir)),
}


# --- marts ------------------------------------------------------------------------------------

QUERIES |= {
    "kpi_overview": lambda spark, sf_dir: marts.kpi_overview(_star(spark, sf_dir)),
    "sales_trend": lambda spark, sf_dir: marts.sales_trend(_star(spark, sf_dir)),
    "sales_trend_filtered": lambda spark, sf_dir: marts.sales_trend(
        _star(spark, sf_dir), year=1997, month=3, state="EU", category="PROMO"
    ),
    "kpi_overview_filtered": lambda spark, sf_dir: marts.kpi_overview(_star(spark, sf_dir), year=1998, state="AS"),
    "orders_by_status": lambda spark, sf_dir: marts.orders_by_status(_star(spark, sf_dir)),
    "top5_categories": lambda spark, sf_dir: marts.top_categories(_star(spark, sf_dir)),
    "top5_sellers": lambda spark, sf_dir: marts.top_sellers(_star(spark, sf_dir)),
    "top5_cities": lambda spark, sf_dir: marts.top_cities(_star(spark, sf_dir)),
    "payments_by_type": lambda spark, sf_dir: marts.payments_by_type(_star(spark, sf_dir)),
    "customers_by_state": lambda spark, sf_dir: marts.customers_by_state(_star(spark, sf_dir)),
    "delivery_performance": lambda spark, sf_dir: marts.delivery_performance(_star(spark, sf_dir)),
}

QUERIES |= {
    "orders_by_status_filtered": lambda spark, sf_dir: marts.orders_by_status(_star(spark, sf_dir), month=5, state="EU"),
    "top5_categories_filtered": lambda spark, sf_dir: marts.top_categories(_star(spark, sf_dir), year=1997, category="PROMO"),
    "top5_sellers_filtered": lambda spark, sf_dir: marts.top_sellers(_star(spark, sf_dir), month=5),
    "top5_cities_filtered": lambda spark, sf_dir: marts.top_cities(_star(spark, sf_dir), state="AS"),
    "payments_by_type_filtered": lambda spark, sf_dir: marts.payments_by_type(_star(spark, sf_dir), year=1996, state="AF"),
    "customers_by_state_filtered": lambda spark, sf_dir: marts.customers_by_state(_star(spark, sf_dir), year=1997, state="AS"),
    "delivery_performance_filtered": lambda spark, sf_dir: marts.delivery_performance(_star(spark, sf_dir), year=1997, month=5),
}
