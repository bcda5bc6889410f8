"""Stored loads on small hand-made deliveries, failures included."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.plans import warehouse as module
from stratamart.plans.warehouse import NullBusinessKey, Warehouse
from stratamart.schemas import BRONZE
from stratamart.session import new_folder
from stratamart.sources import ledger as ledger_module
from stratamart.sources.ledger import NO_NEW_DATA, BatchAlreadyLoaded, BatchRunning, ConcurrentLoad
from stratamart.sources.raw import EmptySource, UnknownTable


@pytest.fixture
def wh(spark):
    return Warehouse(spark, new_folder(spark, "test"))


def frame(spark, table, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{c} string" for c in BRONZE[table]))


def order(n, customer="c1", status="new", day="2018-01-05"):
    stamps = [f"{day} 10:00:00" if day else "", "", "", "", ""]
    return (str(n), customer, status, *stamps)


def item(n, line="1", product="p1", seller="s1", price="5.00"):
    return (str(n), line, product, seller, "2018-01-09", price, "1.00")


CUSTOMERS = [("c1", "u1", "01234", "x", "sp"), ("c2", "u1", "01234", "y", "sp"), ("c3", "u3", "01234", "z", "rj")]
PRODUCTS = [("p1", "toys", *["1"] * 7)]
SELLERS = [("s1", "01234", "x", "sp")]
TRANSLATION = [('"toys"', "toys_en")]


def base(wh, spark):
    wh.load_bronze_rows("customers", frame(spark, "customers", *CUSTOMERS), "c", "c.csv")
    wh.load_bronze_rows("products", frame(spark, "products", *PRODUCTS), "p", "p.csv")
    wh.load_bronze_rows("sellers", frame(spark, "sellers", *SELLERS), "s", "s.csv")
    wh.load_bronze_rows("category_translation", frame(spark, "category_translation", *TRANSLATION), "t", "t.csv")
    wh.load_bronze_rows("order_payments", frame(spark, "order_payments", ("1", "1", "card", "1", "6.00")), "y", "y.csv")


def orders(wh):
    return {r.order_id: r.order_status for r in wh.silver("orders").collect()}


def test_upsert_over_loads(wh, spark):
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1), order(2), order(3)), "b1", "1.csv")
    first = wh.load_silver("orders")
    assert (first["rows_inserted"], first["rows_updated"], first["rows_rejected"]) == (3, 0, 0)
    second_rows = [order(2, status="paid"), order(4), order("", status="lost"), order(5, status="")]
    wh.load_bronze_rows("orders", frame(spark, "orders", *second_rows), "b2", "2.csv")
    second = wh.load_silver("orders")
    assert (second["rows_extracted"], second["rows_inserted"], second["rows_updated"]) == (4, 2, 1)
    assert (second["rows_check"], second["rows_rejected"], second["rows_loaded"]) == (1, 1, 3)
    assert orders(wh) == {"1": "NEW", "2": "PAID", "3": "NEW", "4": "NEW", "5": None}
    assert [r.data_quality_reason for r in wh.quarantine("orders").collect()] == ["Missing order_id"]
    third = wh.load_silver("orders")
    assert third["status"] == NO_NEW_DATA and third["rows_extracted"] == 0
    state = wh.ledger.pipelines().where("pipeline_name = 'silver_orders'").first()
    assert (state.watermark_value, state.is_active) == ("2", 1)


def test_rejected_newer_version_leaves_the_old_row(wh, spark):
    wh.load_bronze_rows("order_items", frame(spark, "order_items", item(1)), "b1", "1.csv")
    wh.load_silver("order_items")
    wh.load_bronze_rows("order_items", frame(spark, "order_items", item(1, product="")), "b2", "2.csv")
    again = wh.load_silver("order_items")
    assert (again["rows_loaded"], again["rows_rejected"]) == (0, 1)
    assert [(r.product_id, r.source_load_id) for r in wh.silver("order_items").collect()] == [("p1", 1)]


def test_increments_write_what_they_bring_and_compaction_keeps_the_rows(wh, spark):
    for load in range(3):
        rows = [order(n, status=f"s{load}") for n in range(load * 7, load * 7 + 20)]
        wh.load_bronze_rows("orders", frame(spark, "orders", *rows), f"b{load}", "x.csv")
        wh.load_silver("orders")
    wh.load_bronze_rows("orders", frame(spark, "orders", order(3, status="last")), "one", "x.csv")
    one = wh.load_silver("orders")
    assert (one["rows_updated"], one["rows_inserted"]) == (1, 0)
    assert spark.read.parquet(f"{wh.root}/silver/orders/version={one['run_id']}").count() == 1
    before = orders(wh)
    assert len(before) == 34 and before["3"] == "LAST"
    wh.compact_silver("orders")
    assert orders(wh) == before
    files = wh.silver("orders").inputFiles()
    assert files and len({f.split("version=")[1].split("/")[0] for f in files}) == 1
    assert wh.load_silver("orders")["status"] == NO_NEW_DATA


def test_facts_read_only_versions_they_have_not_seen(wh, spark):
    base(wh, spark)
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1), order(2)), "o", "o.csv")
    wh.load_bronze_rows("order_items", frame(spark, "order_items", item(1)), "i", "i.csv")
    wh.refresh()
    wh.load_bronze_rows("order_items", frame(spark, "order_items", item(2), item(1, price="7.00")), "i2", "i2.csv")
    new = wh.load_silver("order_items")
    commits = wh.ledger.commits("gold_fact_sales")
    files = wh._to_try("fact_sales", commits)[0].inputFiles()
    assert {f.split("version=")[1].split("/")[0] for f in files if "/silver/order_items/" in f} == {str(new["run_id"])}
    assert wh.load_fact("fact_sales")["rows_inserted"] == 1
    assert {(r.order_id, str(r.price)) for r in wh.gold("fact_sales").collect()} == {("1", "5.00"), ("2", "5.00")}
    keys = {r.order_id: r.sales_key for r in wh.gold("fact_sales").collect()}
    rebuilt = wh.load_fact("fact_sales", refresh=True)
    assert (rebuilt["rows_updated"], rebuilt["rows_inserted"]) == (2, 0)
    assert {(r.order_id, str(r.price)) for r in wh.gold("fact_sales").collect()} == {("1", "7.00"), ("2", "5.00")}
    assert {r.order_id: r.sales_key for r in wh.gold("fact_sales").collect()} == keys
    again = wh.load_fact("fact_sales")
    assert again["status"] == NO_NEW_DATA and again["rows_extracted"] == 2


def test_a_clock_that_goes_back_hides_nothing(wh, spark, monkeypatch):
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1)), "b1", "1.csv")
    wh.load_silver("orders")
    real = ledger_module.time.time_ns
    monkeypatch.setattr(ledger_module.time, "time_ns", lambda: real() - 3600 * 10**9)
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1, status="paid")), "b2", "2.csv")
    assert wh.load_silver("orders")["rows_updated"] == 1
    assert orders(wh) == {"1": "PAID"}


def test_second_writer_of_a_number_fails(wh, spark):
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1)), "b1", "1.csv")
    other = Warehouse(spark, wh.root)
    assert other.ledger.commits("silver_orders") == []
    wh.load_silver("orders")
    with pytest.raises(ConcurrentLoad):
        other.ledger.commit("silver_orders", 1, [1], 1)
    other.ledger.commits("silver_orders")
    other.ledger.commit("silver_orders", None, [], 1)


def test_rows_without_a_key_are_all_kept(wh, spark):
    rows = [order("", customer=f"c{n}") for n in range(3)] + [order("", customer="c0"), order(1)]
    wh.load_bronze_rows("orders", frame(spark, "orders", *rows), "b1", "1.csv")
    done = wh.load_silver("orders")
    assert (done["rows_rejected"], done["rows_inserted"]) == (1, 1)
    assert wh.quarantine("orders").count() == 4
    plan = wh.quarantine("orders")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_quality_status" in plan


def test_two_increments_equal_one_load(wh, spark):
    one = Warehouse(spark, new_folder(spark, "test"))
    parts = [[order(n, status="a") for n in range(10)], [order(n, status="b") for n in range(5, 15)]]
    for number, part in enumerate(parts):
        wh.load_bronze_rows("orders", frame(spark, "orders", *part), f"b{number}", "x.csv")
        wh.load_silver("orders")
        one.load_bronze_rows("orders", frame(spark, "orders", *part), f"b{number}", "x.csv")
    one.load_silver("orders")
    assert orders(wh) == orders(one)


def test_refused_batch_changes_nothing(wh, spark):
    rows = frame(spark, "orders", order(1))
    wh.load_bronze_rows("orders", rows, "b1", "1.csv")
    before = sorted(map(tuple, wh.ledger.batches().collect()))
    for _ in range(2):
        with pytest.raises(BatchAlreadyLoaded):
            wh.load_bronze_rows("orders", rows, "b1", "1.csv")
    assert sorted(map(tuple, wh.ledger.batches().collect())) == before
    assert wh.bronze("orders").count() == 1


def test_running_batch_is_refused_until_taken_over(wh, spark):
    wh.ledger.start_batch("bronze_orders", "b1", "1.csv")
    rows = frame(spark, "orders", order(1))
    with pytest.raises(BatchRunning):
        wh.load_bronze_rows("orders", rows, "b1", "1.csv")
    result = wh.load_bronze_rows("orders", rows, "b1", "1.csv", takeover=True)
    assert result["batch_id"] == 2
    assert {r.batch_id: r.status for r in wh.ledger.batches().collect()} == {1: "Failed", 2: "Success"}


def test_empty_delivery_fails_and_can_be_retried(wh, spark):
    with pytest.raises(EmptySource):
        wh.load_bronze_rows("orders", frame(spark, "orders", order(1)).limit(0), "b1", "1.csv")
    run = wh.ledger.runs().first()
    assert run.status == "Failed" and "no data" in run.error_message
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1)), "b1", "1.csv")
    assert sorted((r.batch_id, r.status) for r in wh.ledger.batches().collect()) == [(1, "Failed"), (2, "Success")]
    assert [r.load_id for r in wh.bronze("orders").collect()] == [2]


def test_header_only_file_and_unknown_table(wh, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
    with pytest.raises(EmptySource):
        wh.load_bronze("sellers", str(path), "b1", "empty.csv")
    with pytest.raises(UnknownTable):
        wh.load_bronze("nothing", str(path), "b1", "empty.csv")
    with pytest.raises(UnknownTable):
        wh.load_bronze_rows("nothing", None, "b1", "empty.csv")


def test_batch_that_ends_after_a_later_one_still_arrives(wh, spark):
    early = wh.ledger.start_batch("bronze_orders", "slow", "slow.csv")
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1, status="late")), "fast", "fast.csv")
    wh.load_silver("orders")
    stamped = module.stamp(frame(spark, "orders", order(1, status="early"), order(2)), early.batch_id, early.batch_start_time, "slow.csv")
    stamped.drop("load_id").write.parquet(f"{wh.root}/bronze/orders/load_id={early.batch_id}")
    wh.ledger.end_batch(early, "Success", 2)
    assert wh.load_silver("orders")["rows_inserted"] == 1
    assert orders(wh) == {"1": "LATE", "2": "NEW"}


def test_a_load_that_dies_leaves_the_last_state(wh, spark, monkeypatch):
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1)), "b1", "1.csv")
    wh.load_silver("orders")
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1, status="paid"), order(2)), "b2", "2.csv")

    def broken(*args, **named):
        raise OSError("lost")

    monkeypatch.setattr(wh.ledger, "commit", broken)
    with pytest.raises(OSError):
        wh.load_silver("orders")
    assert orders(wh) == {"1": "NEW"}
    monkeypatch.undo()
    assert wh.load_silver("orders")["rows_loaded"] == 2
    assert orders(wh) == {"1": "PAID", "2": "NEW"}
    assert "Failed" in {r.status for r in wh.ledger.runs().collect()}


def test_key_digits_are_settled_once(wh, spark):
    assert Warehouse(spark, wh.root, key_digits=5).key_digits == 3


@pytest.mark.parametrize("digits", [1, 4])
def test_keys_are_dense_with_any_number_of_slots(spark, digits):
    wh = Warehouse(spark, new_folder(spark, "test"), key_digits=digits)
    base(wh, spark)
    wh.load_silver("customers")
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1)), "o", "o.csv")
    wh.load_silver("orders")
    wh.load_dim("dim_customer")
    assert sorted(r.customer_key for r in wh.gold("dim_customer").collect()) == [1, 2]
    assert wh.load_dim("dim_customer")["status"] == NO_NEW_DATA


def test_star(wh, spark):
    base(wh, spark)
    rows = [order(1, "c1", day="2018-01-05"), order(2, "c2", day="2018-02-05"), order(3, "c9"), order(4, "c3", day="")]
    wh.load_bronze_rows("orders", frame(spark, "orders", *rows), "o", "o.csv")
    items = [item(1), item(2), item(3), item(4), item(1, "2", product="p2"), item(1, "3", seller="s9"), item(8)]
    wh.load_bronze_rows("order_items", frame(spark, "order_items", *items), "i", "i.csv")
    done = wh.refresh()
    assert done["gold_dim_customer"]["rows_inserted"] == 2
    keys = {r.customer_unique_id: (r.customer_key, r.customer_id) for r in wh.gold("dim_customer").collect()}
    assert sorted(k for k, _ in keys.values()) == [1, 2]
    assert keys["u1"][1] == "c2", "the customer_id with the latest purchase stands for the customer"
    assert [r.product_category_name_english for r in wh.gold("dim_product").collect()] == ["toys_en"]
    assert (done["gold_fact_sales"]["rows_inserted"], done["gold_fact_sales"]["rows_rejected"]) == (2, 5)
    sales = {(r.order_id, r.order_item_id): r.order_date_key for r in wh.gold("fact_sales").collect()}
    assert sales == {("1", 1): 20180105, ("2", 1): 20180205}
    assert {r.order_id: r.purchase_date_key for r in wh.gold("fact_delivery").collect()} == {
        "1": 20180105, "2": 20180205, "4": None,
    }

    # A second delivery: the missing product and order arrive, a sold item changes its price.
    wh.load_bronze_rows("products", frame(spark, "products", ("p2", "toys", *["1"] * 7)), "p2", "p2.csv")
    wh.load_bronze_rows("orders", frame(spark, "orders", order(8, "c3")), "o2", "o2.csv")
    wh.load_bronze_rows("order_items", frame(spark, "order_items", item(1, price="9.00"), item(9)), "i2", "i2.csv")
    again = wh.refresh()
    assert (again["gold_fact_sales"]["rows_inserted"], again["gold_fact_sales"]["rows_rejected"]) == (2, 4)
    assert again["gold_fact_sales"]["rows_extracted"] == 4
    sold = {(r.order_id, r.order_item_id): (r.sales_key, str(r.price)) for r in wh.gold("fact_sales").collect()}
    assert set(sold) == {("1", 1), ("2", 1), ("1", 2), ("8", 1)}
    assert sold[("1", 1)][1] == "5.00", "facts are only added to"
    assert sorted(k for k, _ in sold.values()) == [1, 2, 3, 4]
    assert {r.customer_unique_id: (r.customer_key, r.customer_id) for r in wh.gold("dim_customer").collect()} == keys
    products = {r.product_id: r.product_key for r in wh.gold("dim_product").collect()}
    assert products == {"p1": 1, "p2": 2}

    third = wh.refresh()
    assert all(third[f"gold_{n}"]["rows_inserted"] == 0 for n in ("dim_customer", "dim_product", "fact_sales", "fact_delivery"))
    assert third["gold_fact_sales"]["rows_rejected"] == 4, "what was left out is looked at again each time"
    assert wh.gold("fact_sales").count() == 4


def test_fact_without_any_row_fails(wh, spark):
    base(wh, spark)
    wh.load_bronze_rows("orders", frame(spark, "orders", order(1, "c9")), "o", "o.csv")
    for name in ("orders", "customers", "order_payments", "delivery"):
        wh.load_silver(name)
    wh.load_dim("dim_customer")
    with pytest.raises(EmptySource):
        wh.load_fact("fact_payments")
    with pytest.raises(EmptySource):
        wh.load_fact("fact_delivery")
    assert wh.gold("fact_payments").count() == 0


def test_null_business_key_stops_a_dimension(wh, spark, monkeypatch):
    base(wh, spark)
    for name in ("sellers",):
        wh.load_silver(name)
    bad = wh.silver("sellers").withColumn("seller_id", F.lit(None).cast("string"))
    monkeypatch.setattr(module.star, "seller_source", lambda _: bad.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"))
    with pytest.raises(NullBusinessKey):
        wh.load_dim("dim_seller")
    assert wh.gold("dim_seller").count() == 0
    failed = wh.ledger.runs().where("status = 'Failed'").first()
    assert (failed.pipeline_name, failed.rows_rejected) == ("gold_dim_seller", 1)


def test_date_dimension(wh):
    result = wh.load_date_dim(date(2016, 1, 1), date(2018, 12, 31))
    assert result["rows_loaded"] == 1096
    first = wh.gold("dim_date").where("date_key = 20160101").first()
    assert (first.quarter, first.month_name, first.week_of_year, first.day_of_week, first.day_name) == (
        1, "January", 53, 6, "Friday",
    )
    assert wh.load_date_dim()["status"] == NO_NEW_DATA, "bounds once given stay"
    assert wh.load_date_dim(start=date(2017, 1, 1))["rows_loaded"] == 730


def test_calendar_without_bounds_or_purchases_fails(wh):
    with pytest.raises(EmptySource):
        wh.load_date_dim(start=date(2016, 1, 1))
    assert wh.gold("dim_date").count() == 0
