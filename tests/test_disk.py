"""What loads leave on disk, and what they move to get there."""

from pyspark.sql import functions as F

from stratamart.plans import gold
from stratamart.schemas import SILVER
from stratamart.session import shuffles_dropped
from stratamart.sources.versions import Versions
from tests.test_versions import base, commits, item, load, many_files, order, wh  # noqa: F401


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def staged(wh, spark):  # noqa: F811
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{wh.root}/staging")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.getContentSummary(path).getFileCount() if store.exists(path) else 0


def test_loads_leave_no_shuffle_files_and_nothing_staged(wh, spark):  # noqa: F811
    base(wh, spark)
    before = shuffle_files(spark)
    load(wh, spark, "orders", [order(1), order(2, "c2")], 0)
    load(wh, spark, "orders", [order(1, status="paid"), order(3)], 1)
    load(wh, spark, "order_items", [item(1), item(2), item(9)], 0)
    done = wh.refresh()
    assert done["gold_fact_sales"]["rows_inserted"] == 2
    load(wh, spark, "order_items", [item(3)], 1)
    assert wh.load_fact("fact_sales", refresh=True)["rows_updated"] == 2
    assert wh.gold("fact_sales").count() == 3
    assert staged(wh, spark) == 0
    # a stage that a plan no longer has when it ends, as one side turned out empty, keeps its three files a while
    assert len(shuffle_files(spark) - before) <= 12


def test_the_setting_is_restored_by_the_last_thread(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    first, second = shuffles_dropped(spark), shuffles_dropped(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(name, None) == before


def test_deliveries_lie_where_their_orders_lie(wh, spark, many_files, monkeypatch):  # noqa: F811
    seen, write = {}, Versions.write

    def noted(self, rows, version, dealt=False):
        seen[self.folder.rsplit("/", 1)[1]] = dealt
        return write(self, rows, version, dealt)

    monkeypatch.setattr(Versions, "write", noted)
    load(wh, spark, "orders", [order(n) for n in range(400)], 0)
    assert wh.load_silver("delivery")["rows_inserted"] == 400 and seen["delivery"]
    kept = wh._versions("silver", "delivery")
    assert len(kept.stored(commits(wh, "delivery")).inputFiles()) > 2
    keys = spark.createDataFrame([("17",)], "order_id string")
    assert len(kept.files_with(keys, 1, commits(wh, "delivery"))) <= 2  # a key is still looked for in few files
    load(wh, spark, "orders", [order(n, status="paid") for n in range(9)], 1)
    load(wh, spark, "orders", [order(n, status="sent") for n in range(5, 500)], 2)
    assert wh.load_silver("delivery")["rows_updated"] == 400 and not seen["delivery"]
    assert wh.silver("delivery").count() == 500


def test_the_lookup_joins_last(spark):
    """What it adds to a sale is not shuffled for the dimensions."""
    items = spark.createDataFrame([("o1", 1, "p1", "s1", None, None)], "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), freight_value decimal(18,2)")
    items = items.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER["order_items"].schema if f.name not in items.columns))
    lookup = spark.createDataFrame([("o1", "c1", "u1", 5, 20180101)], "order_id string, customer_id string, customer_unique_id string, customer_key long, order_date_key int")
    dims = [spark.createDataFrame([(f"{x[0]}1", 7)], f"{x}_id string, {x}_key long") for x in ("product", "seller")]
    found = gold.sales_candidates(items, lookup, *dims, SILVER["order_items"].schema.fieldNames())
    joins = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert "order_id" in joins[0] and [r[gold.REASON] for r in found.collect()] == [gold.LOADABLE]
