"""Versions of stored tables: marks, key filters, totals, and what the loads read of them."""

import random
import shutil
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.plans.warehouse import Warehouse
from stratamart.schemas import SILVER, TOTALS
from stratamart.session import new_folder
from stratamart.sources import tables, versions
from stratamart.sources.ledger import PIPELINE_CONTROL, SNAPSHOT_EVERY, Ledger
from tests.test_warehouse import CUSTOMERS, base, frame, item, order


@pytest.fixture
def wh(spark):
    return Warehouse(spark, new_folder(spark, "test"))


@pytest.fixture
def many_files(spark):
    """Small tables in as many files as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def load(wh, spark, table, rows, number, silver=True):
    wh.load_bronze_rows(table, frame(spark, table, *rows), f"{table}{number}", "x.csv")
    return wh.load_silver(table) if silver else None


def commits(wh, table):
    return tables.current(wh.ledger.commits(f"silver_{table}"))


def test_reading_three_versions_shuffles_nothing(wh, spark, monkeypatch):
    for number in range(3):
        load(wh, spark, "orders", [order(n, status=f"s{number}") for n in range(number * 4, number * 4 + 10)], number)
    expected = {str(n): "S2" if n >= 8 else "S1" if n >= 4 else "S0" for n in range(18)}
    rows = wh.silver("orders")
    text = plan(rows)
    assert "BroadcastExchange" in text and all(x not in text for x in ("hashpartitioning", "SinglePartition", "rangepartitioning", "Window", "Sort "))
    assert {r.order_id: r.order_status for r in rows.collect()} == expected
    monkeypatch.setattr(versions, "MARKS_BROADCAST", 0)
    assert {r.order_id: r.order_status for r in wh.silver("orders").collect()} == expected
    wh.compact_silver("orders")
    assert {r.order_id: r.order_status for r in wh.silver("orders").collect()} == expected
    assert "Exchange" not in plan(wh.silver("orders"))


def test_a_small_increment_opens_few_files(wh, spark, many_files):
    load(wh, spark, "orders", [order(n) for n in range(400)], 0)
    kept = wh._versions("silver", "orders")
    every = kept.stored(commits(wh, "orders")).inputFiles()
    assert len(every) == 8
    keys = spark.createDataFrame([("17",)], "order_id string")
    files = kept.files_with(keys, 1, commits(wh, "orders"))
    assert 1 <= len(files) <= 2
    assert wh._silver_rows("orders", files).where("order_id = '17'").count() == 1
    absent = kept.files_with(spark.createDataFrame([("none",)], "order_id string"), 1, commits(wh, "orders"))
    assert len(absent) <= 1
    assert kept.files_with(keys, 399, commits(wh, "orders")) is None, "so many keys may be anywhere"
    done = load(wh, spark, "orders", [order(17, status="paid"), order(1000)], 1)
    assert (done["rows_updated"], done["rows_inserted"]) == (1, 1)


def test_a_filter_that_says_yes_to_all_changes_no_row(wh, spark, monkeypatch):
    monkeypatch.setattr(versions, "_probe", lambda i: F.lit(i).cast("long"))
    load(wh, spark, "orders", [order(n, status="a") for n in range(40)], 0)
    done = load(wh, spark, "orders", [order(3, status="b"), order(50, status="b")], 1)
    assert (done["rows_updated"], done["rows_inserted"]) == (1, 1)
    assert {r.order_id for r in wh.silver("orders").where("order_status = 'B'").collect()} == {"3", "50"}


@pytest.mark.parametrize("seed", [1])
def test_random_loads_equal_a_dictionary(wh, spark, seed):
    """Updates, late loads, rejected rows and a compaction; totals from commits equal a scan."""
    rng, model = random.Random(seed), {}
    early = wh.ledger.start_batch("bronze_order_items", "late", "late.csv")
    late = {str(n): (early.batch_id, "1.50") for n in rng.sample(range(40), 8)}
    for number in range(4):
        if number == 2:
            wh.compact_silver("order_items")
        rows = {str(n): rng.choice(["2.00", "3.25", ""]) for n in rng.sample(range(40), 15)}
        if number == 3:
            from stratamart.plans import warehouse as module

            part = frame(spark, "order_items", *(item(n, price=p) for n, (_, p) in late.items()))
            stamped = module.stamp(part, early.batch_id, early.batch_start_time, "late.csv")
            stamped.drop("load_id").write.parquet(f"{wh.root}/bronze/order_items/load_id={early.batch_id}")
            wh.ledger.end_batch(early, "Success", len(late))
            assert wh.load_silver("order_items")["rows_inserted"] == len(set(late) - set(model))
            model = {k: v for k, v in late.items()} | model
        done = load(wh, spark, "order_items", [item(n, price=p) for n, p in rows.items()] + [item(99, product="")], number)
        load_id = wh.ledger.commits("silver_order_items")[-1].load_ids[-1]
        assert done["rows_updated"] == len(set(rows) & set(model)) and done["rows_rejected"] == 1
        model |= {n: (load_id, p) for n, p in rows.items()}
    found = {r.order_id: (r.source_load_id, str(r.price) if r.price is not None else "") for r in wh.silver("order_items").collect()}
    assert found == model
    state = {(r.status, r.measure): r.state_value for r in wh.state().where("table_name = 'order_items'").collect()}
    scan = wh.silver("order_items").groupBy("data_quality_status").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in TOTALS["order_items"])).collect()
    for r in scan:
        assert state[r.data_quality_status, "rows"] == r.n
        assert all(state.get((r.data_quality_status, c), Decimal(0)) == (r[c] or 0) for c in TOTALS["order_items"])


def test_a_rejected_row_holds_no_key(wh, spark):
    load(wh, spark, "order_items", [item(1, product=""), item(2)], 0)
    done = load(wh, spark, "order_items", [item(1), item(2)], 1)
    assert (done["rows_updated"], done["rows_inserted"]) == (1, 1)
    new = wh._brought("order_items", commits(wh, "order_items")[1:])
    assert {r.order_id: r._new for r in new.collect()} == {"1": True, "2": False}


def test_one_changed_city_writes_one_member(wh, spark):
    base(wh, spark)
    load(wh, spark, "orders", [order(1), order(2, "c2", day="2018-02-05"), order(3, "c3")], 0)
    wh.load_silver("customers")
    first = wh.load_dim("dim_customer")
    assert (first["rows_inserted"], first["rows_updated"]) == (2, 0)
    keys = {r.customer_unique_id: r.customer_key for r in wh.gold("dim_customer").collect()}
    load(wh, spark, "customers", [("c3", "u3", "01234", "moved", "rj"), CUSTOMERS[0]], "again")
    again = wh.load_dim("dim_customer")
    assert (again["rows_inserted"], again["rows_updated"]) == (0, 1)
    assert spark.read.parquet(f"{wh.root}/gold/dim_customer/version={again['run_id']}").count() == 1
    members = {r.customer_unique_id: (r.customer_key, r.customer_city) for r in wh.gold("dim_customer").collect()}
    assert members == {"u1": (keys["u1"], "y"), "u3": (keys["u3"], "moved")}
    load(wh, spark, "orders", [order(4, "c1", day="2018-03-05")], 1)
    assert wh.load_dim("dim_customer")["rows_updated"] == 1, "a later purchase makes another customer_id stand for u1"
    assert {r.customer_unique_id: r.customer_id for r in wh.gold("dim_customer").collect()} == {"u1": "c1", "u3": "c3"}


def test_touched_groups_equal_a_full_build(wh, spark):
    """Customers move between groups, orders change customer and day; each time the stored members are those of a full build."""
    rng = random.Random(7)
    days = [f"2018-01-{n:02d}" for n in range(1, 29)]

    def some_customers(n):
        return [(f"c{i}", f"u{rng.randrange(5)}", "01234", rng.choice("xyz"), "sp") for i in rng.sample(range(12), n)]

    def some_orders(n):
        return [order(i, f"c{rng.randrange(12)}", day=rng.choice(days)) for i in rng.sample(range(30), n)]

    for number in range(3):
        load(wh, spark, "customers", some_customers(12 if number == 0 else 2), number)
        load(wh, spark, "orders", some_orders(25 if number == 0 else 3), number)
        wh.load_dim("dim_customer")
        members = {r.customer_unique_id: r.asDict() for r in wh.gold("dim_customer").collect()}
        full = {r.customer_unique_id: r.asDict() for r in wh.dim_source("dim_customer").collect()}
        assert sorted(m["customer_key"] for m in members.values()) == list(range(1, len(members) + 1))
        for key, row in full.items():
            assert {k: members[key][k] for k in row} == row


def test_a_new_product_tries_its_own_items_only(wh, spark):
    base(wh, spark)
    load(wh, spark, "orders", [order(1), order(2)], 0, silver=False)
    items = [item(1), item(1, "2", product="p2"), item(1, "3", product="p3"), item(2, seller="s9"), item(7)]
    load(wh, spark, "order_items", items, 0, silver=False)
    assert wh.refresh()["gold_fact_sales"]["rows_rejected"] == 4
    load(wh, spark, "products", [("p2", "toys", *["1"] * 7)], 1)
    wh.load_dim("dim_product")
    rows, tried = wh._to_try("fact_sales", wh.ledger.commits("gold_fact_sales"))
    assert [(r.order_id, r.order_item_id) for r in rows.collect()] == [("1", 2)] and tried.count() == 1
    done = wh.load_fact("fact_sales")
    assert (done["rows_inserted"], done["rows_rejected"]) == (1, 3)
    load(wh, spark, "order_items", [item(7, product="p2"), item(2, seller="s1")], 1)
    done = wh.load_fact("fact_sales")
    assert (done["rows_inserted"], done["rows_rejected"]) == (1, 2), "a left-out row that changed is tried as it is now"
    assert wh.load_fact("fact_sales", refresh=True)["rows_rejected"] == 2
    state = {(r.table_name, r.measure): int(r.state_value) for r in wh.state().where("table_name = 'fact_sales'").collect()}
    assert state["fact_sales", "rows"] == wh.gold("fact_sales").count() == 3


def test_a_small_delta_reads_few_partner_files(wh, spark, many_files, monkeypatch):
    wh.load_bronze_rows("customers", frame(spark, "customers", *((f"c{n}", f"u{n}", "01234", "x", "sp") for n in range(100))), "c", "c.csv")
    for table, rows in (("products", [("p1", "toys", *["1"] * 7)]), ("sellers", [("s1", "01234", "x", "sp")]), ("category_translation", [("toys", "t")]), ("order_payments", [("1", "1", "card", "1", "6.00")])):
        wh.load_bronze_rows(table, frame(spark, table, *rows), table, "x.csv")
    load(wh, spark, "orders", [order(n, f"c{n % 100}") for n in range(300)], 0, silver=False)
    load(wh, spark, "order_items", [item(n) for n in range(0, 300, 2)], 0, silver=False)
    wh.refresh()
    load(wh, spark, "order_items", [item(17), item(900)], 1)
    assert wh._few("fact_sales", wh.ledger.commits("gold_fact_sales"))
    seen, join = [], wh._star_join

    def noted(name, rows, few=False):
        out = join(name, rows, few)
        seen.extend(f for f in out.inputFiles() if "/silver/orders/" in f or "/silver/customers/" in f)
        return out

    monkeypatch.setattr(wh, "_star_join", noted)
    done = wh.load_fact("fact_sales")
    assert (done["rows_inserted"], done["rows_rejected"]) == (1, 1)
    assert 2 <= len(seen) <= 5, "of 16 files of orders and customers"


def test_links_of_a_fact_in_one_scan(wh, spark):
    from stratamart.plans import validation

    base(wh, spark)
    load(wh, spark, "orders", [order(1)], 0, silver=False)
    load(wh, spark, "order_items", [item(1)], 0, silver=False)
    wh.refresh()
    gold = dict(wh.gold_tables().items())
    found = validation.foreign_keys(gold)
    assert plan(found).count("gold/fact_sales/") <= 1 and sum(r.invalid_rows for r in found.collect()) == 0
    gold["dim_seller"] = gold["dim_seller"].where("seller_key < 0")
    broken = {r.check_name: r.invalid_rows for r in validation.foreign_keys(gold).collect()}
    assert broken["FactSales - Seller"] == 1 and sum(broken.values()) == 1 and len(broken) == 7


def test_a_table_opens_from_a_snapshot_and_a_short_tail(spark):
    ledger = Ledger(spark, new_folder(spark, "ledger"))
    name = "pipeline_control/pipeline=x"
    rows = spark.range(1, 501).select(
        F.lit("x").alias("pipeline_name"), F.col("id").cast("string").alias("watermark_value"), F.lit(None).cast("timestamp_ntz").alias("last_successful_run"),
        F.lit(1).alias("is_active"), F.col("id").alias("version"), F.array("id").alias("load_ids"), F.lit(False).alias("whole"), F.lit("{}").alias("seen"), F.col("id").alias("seq"),
    )
    rows.repartition(1).write.partitionBy("seq").parquet(f"{ledger.root}/{name}")
    assert ledger.parts(name) == (0, list(range(1, 501)))
    assert [c.version for c in ledger.commits("x")] == list(range(1, 501))
    ledger.commit("x", 501, [501], 501)
    opened = Ledger(spark, ledger.root)
    assert opened.parts(name) == (500, [501])
    assert [c.version for c in opened.commits("x")] == list(range(1, 502)) == [c.version for c in ledger.commits("x")]
    opened.commit("x", 502, [502], 502)
    assert [c.version for c in ledger.commits("x")][-1] == 502, "rows of other ledgers are seen"
    assert ledger.pipelines().first().watermark_value == "502"
    shutil.rmtree(f"{ledger.root}/snapshots".removeprefix("file:"))  # a test's own folder
    third = Ledger(spark, ledger.root)
    assert len(third.commits("x")) == 502
    third.commit("x", 503, [503], 503)
    assert Ledger(spark, ledger.root).parts(name) == (502, [503])
    for n in range(504, 504 + SNAPSHOT_EVERY):
        third.commit("x", n, [n], n)
    upto, tail = third.parts(name)
    assert upto == 518 and len(tail) < 20
    assert third.events("pipeline_control", PIPELINE_CONTROL).count() == 519


def test_totals_name_stored_columns():
    assert all(set(columns) <= set(SILVER[name].schema.fieldNames()) for name, columns in TOTALS.items() if name in SILVER)
