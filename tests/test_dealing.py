"""Bitmaps without a sort, and increments that are ranked where they are dealt to."""

from pyspark.sql import functions as F

from stratamart.plans import silver
from stratamart.sources.versions import BUCKET, bitmaps
from tests.test_warehouse import frame, order


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def positions(spark):
    p = F.when(F.col("id") % 7 == 6, BUCKET - 1).when(F.col("id") % 7 == 5, 1030).otherwise(F.pmod(F.xxhash64("id"), F.lit(BUCKET)))
    return spark.range(30_000).select((F.col("id") % 7).alias("a"), (F.col("id") % 3).cast("string").alias("f"), p.alias("p"))


def test_bitmaps_equal_those_of_spark_and_sort_no_positions(spark):
    rows = positions(spark)
    found = bitmaps(rows, ["a", "f"], "p")
    text = plan(found)
    assert "SortAggregate" not in text and "HashAggregate" in text and "Sort " not in text
    expected = rows.groupBy("a", "f").agg(F.bitmap_construct_agg("p").alias("bits"))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def increment(spark):
    rows = [order(n % 9, status=f"s{n}") for n in range(30)] + [order(3, status=f"t{n}") for n in range(40)]
    stamped = {"load_id": F.lit(1).cast("bigint"), "load_datetime": F.lit("2024-01-01").cast("timestamp_ntz"), "source_file": F.lit("x.csv")}
    bronze = frame(spark, "orders", *rows).withColumns(stamped)
    return bronze.unionByName(bronze.limit(3).withColumn("order_id", F.lit(None).cast("string")))


def test_an_increment_moves_once_and_hot_keys_change_no_row(spark, monkeypatch):
    bronze = increment(spark)
    dealt = silver.build_stored(bronze, "orders")
    text = plan(dealt)
    assert "_slot" in text and "hashpartitioning(order_id" not in text  # one shuffle by the slot serves ranking and storing
    rows = sorted(map(str, dealt.collect()))
    assert silver.hot_keys(silver.cleaned(bronze, "orders"), "orders") == []
    apart = silver.cleaned(bronze, "orders").where("order_id is null").count()
    assert apart == 3 and len(rows) == 9 + apart
    monkeypatch.setattr(silver, "HOT_ROWS", 20)
    assert len(silver.hot_keys(silver.cleaned(bronze, "orders").where("order_id is not null"), "orders")) == 1
    hot = silver.build_stored(bronze, "orders")
    assert "hashpartitioning(order_id" in plan(hot)  # the hot key alone is thinned out before the shuffle
    assert sorted(map(str, hot.collect())) == rows
