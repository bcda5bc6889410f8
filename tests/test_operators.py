import random

import pytest
from pyspark.sql import functions as F

from stratamart.operators import checks
from stratamart.operators.increments import probe, watermark_value
from stratamart.operators.keys import assign_keys
from stratamart.operators.latest import latest, newest_first
from stratamart.operators.upsert import change_counts, changes, insert_absent, upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_is_repeatable_and_limits_before_the_shuffle(spark):
    data = [(k % 3 if k % 7 else None, k % 2, f"v{k:03d}") for k in range(60)]
    df = spark.createDataFrame(data, "k int, load_id int, v string").withColumn("load_datetime", F.lit(1))
    newest = latest(df, ["k"], newest_first(["v"]))
    best = {}
    for k, load, v in data:
        if k not in best or (-load, v) < best[k]:
            best[k] = (-load, v)
    assert {(r.k, r.v) for r in newest.collect()} == {(k, v) for k, (_, v) in best.items()}
    text = plan(newest.select("k"))
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below, text


def model_upsert(target, source):
    """Brute force: key -> (value, load, change)."""
    out = {k: (v, load, "kept") for k, (v, load) in target.items()}
    for k, (v, load) in source.items():
        if k not in target:
            out[k] = (v, load, "inserted")
        elif load > target[k][1]:
            out[k] = (v, load, "updated")
    return sorted((k, *rest) for k, rest in out.items())


@pytest.mark.parametrize("seed", range(4))
def test_upsert_against_brute_force(spark, seed):
    rng = random.Random(seed)
    def side(name):
        return {k: (f"{name}{k}", rng.randint(1, 3)) for k in rng.sample(range(40), 25)}
    target, source = side("t"), side("s")
    frames = [
        spark.createDataFrame([(k, v, n) for k, (v, n) in d.items()], "k int, v string, load int")
        for d in (target, source)
    ]
    expected = model_upsert(target, source)
    merged = upsert(*frames, ["k"], newer="load").select("k", "v", "load", "change_type")
    assert rows(merged) == expected
    marked = changes(frames[0].select("k", "load"), frames[1], ["k"], newer="load").where("change_type <> 'stale'")
    assert rows(marked.select("k", "v", "load", "change_type")) == [e for e in expected if e[3] != "kept"]
    counts = change_counts(merged).first()
    assert counts.rows_updated == sum(e[3] == "updated" for e in expected)
    assert counts.rows_inserted == sum(e[3] == "inserted" for e in expected)
    assert counts.rows_loaded == counts.rows_updated + counts.rows_inserted
    fresh = sorted((k, v, n) for k, (v, n) in source.items() if k not in target)
    assert rows(insert_absent(*frames, ["k"])) == fresh


def test_upsert_keeps_the_surrogate_key(spark):
    target = spark.createDataFrame([("a", "old", 7), ("b", "old", 8)], "k string, v string, sk int")
    source = spark.createDataFrame([("a", "new"), ("c", "new")], "k string, v string")
    merged = upsert(target, source, ["k"], carry="sk").select("k", "v", "sk", "change_type")
    assert {tuple(r) for r in merged.collect()} == {
        ("a", "new", 7, "updated"), ("b", "old", 8, "kept"), ("c", "new", None, "inserted"),
    }


def test_upsert_twice_changes_nothing(spark):
    source = spark.createDataFrame([(1, "x", 5), (2, "y", 5)], "k int, v string, load int")
    once = upsert(source.limit(0), source, ["k"], newer="load").drop("change_type")
    twice = upsert(once, source, ["k"], newer="load")
    assert {r.change_type for r in twice.collect()} == {"kept"}


def test_assigned_keys_are_dense_and_repeatable(spark):
    df = spark.range(5000).select(F.concat(F.lit("m"), "id").alias("k"))
    first = assign_keys(df, "sk", ["k"], 100, "int")
    again = assign_keys(df.repartition(7), "sk", ["k"], 100, "int")
    numbers = dict(tuple(r) for r in first.select("k", "sk").collect())
    assert sorted(numbers.values()) == list(range(101, 5101))
    assert numbers == dict(tuple(r) for r in again.select("k", "sk").collect())


def test_checks(spark):
    fact = spark.createDataFrame([(1, 1), (2, 9), (3, None), (3, 2)], "id int, d int")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "d int, n string")
    assert checks.check_fk("x", fact, "d", dim, "d").first().invalid_rows == 2
    assert checks.check_fk("x", fact, "d", dim, "d", optional=True).first().invalid_rows == 1
    grain = checks.check_grain("x", fact, ["id"]).first()
    assert (grain.total_rows, grain.distinct_grain) == (4, 3)
    assert checks.check_unique("x", dim, "n").first().duplicate_count == 2
    assert checks.duplicate_keys("x", fact, ["id"]).first().violations == 1
    assert {tuple(r) for r in checks.check_not_null("x", fact, ["id", "d"]).collect()} == {("x", "id", 0), ("x", "d", 1)}
    empty = fact.limit(0)
    assert checks.check_fk("x", empty, "d", dim, "d").first().invalid_rows == 0
    assert tuple(checks.check_grain("x", empty, ["id"]).first()) == ("x", 0, 0)


def test_probe_and_watermark(spark):
    df = spark.createDataFrame([(1,), (4,)], "load_id long")
    assert tuple(probe(df).first()) == (4, 2)
    assert tuple(probe(df.limit(0)).first()) == (None, 0)
    assert [watermark_value(t) for t in ("12", None, "x", "")] == [12, 0, 0, 0]


def test_hot_key_join_is_split(spark):
    """A key with a third of the rows: Spark splits its partition and the result is whole."""
    from stratamart.plans.gold import sales_candidates

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = F.col("id")
        items = spark.range(0, 30000, 1, 8).select(
            F.when(n % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("o"), n % 500)).alias("order_id"),
            n.cast("int").alias("order_item_id"),
            F.concat(F.lit("p"), n % 50).alias("product_id"),
            F.concat(F.lit("s"), n % 10).alias("seller_id"),
            F.lit(1).cast("decimal(18,2)").alias("price"),
            F.lit(1).cast("decimal(18,2)").alias("freight_value"),
        )
        lookup = spark.range(500).select(
            F.concat(F.lit("o"), "id").alias("order_id"), F.lit(1).alias("customer_key"), F.lit(20180101).alias("order_date_key")
        ).union(spark.sql("SELECT 'hot', 2, 20180102"))
        products = spark.range(50).select(F.concat(F.lit("p"), "id").alias("product_id"), F.col("id").alias("product_key"))
        sellers = spark.range(10).select(F.concat(F.lit("s"), "id").alias("seller_id"), F.col("id").alias("seller_key"))
        joined = sales_candidates(items, lookup, products, sellers)
        counted = {r.order_date_key: r["count"] for r in joined.groupBy("order_date_key").count().collect()}
        assert counted == {20180101: 20000, 20180102: 10000}
        narrow = items.join(lookup, "order_id", "left")
        narrow.collect()
        assert "skew=true" in plan(narrow)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
