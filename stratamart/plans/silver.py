"""Bronze text to judged, typed silver rows. One build for every table, driven by the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.convert import to_decimal, to_int, to_timestamp_ntz
from stratamart.functions.dates import days_between, delivery_status
from stratamart.functions.text import clean, state_code
from stratamart.operators.latest import latest, newest_first
from stratamart.operators.rules import CHECK, CUSTOMER, ESTIMATE, FLAGGED, PURCHASE, RULES, VALID, classify, flag
from stratamart.schemas import LOAD_COLUMNS, SILVER
from stratamart.sources.versions import slot

#: A key with more rows than this in an increment is thinned out before the shuffle; so many keys of that kind are looked for.
HOT_ROWS, HOT_KEYS = 100_000, 1_000

_CONVERT = {"int": to_int, "money": to_decimal, "stamp": to_timestamp_ntz, "state": state_code}
_CASE = {"lower": "lower", "upper": "upper", "state": "upper"}


def _typed(form: str, text: Column) -> Column:
    return _CONVERT[form](text) if form in _CONVERT else text


def cleaned(bronze: DataFrame, table: str) -> DataFrame:
    """Silver columns under their silver names, still with the load metadata."""
    fields = SILVER[table].fields
    load = LOAD_COLUMNS.fieldNames()
    text = bronze.select(*[clean(f.raw, _CASE.get(f.form)).alias(f.name) for f in fields], *load)
    typed = [_typed(f.form, F.col(f.name)).alias(f.name) for f in fields]
    unreadable = [
        (F.col(f.name).isNotNull() & _typed(f.form, F.col(f.name)).isNull()).alias(flag(f.name))
        for f in fields
        if f.name in FLAGGED.get(table, ())
    ]
    return text.select(*typed, *unreadable, *load)


def _order(rows: DataFrame, table: str) -> list[Column]:
    return newest_first([c for c in rows.columns if c not in SILVER[table].keys and c not in ("load_datetime", "load_id")])


def newest(rows: DataFrame, table: str) -> DataFrame:
    """Latest version of every key of the increment, before any rule looks at it."""
    return latest(rows, SILVER[table].keys, _order(rows, table))


def hot_keys(rows: DataFrame, table: str) -> list[int]:
    """Hashes of the keys that most likely have more than HOT_ROWS rows, from a sketch of the key columns."""
    seen = rows.select(F.xxhash64(*SILVER[table].keys).alias("_hash"))
    found = seen.agg(F.count("*").alias("n"), F.expr(f"approx_top_k(_hash, {HOT_KEYS}, {16 * HOT_KEYS})").alias("top")).first()
    return [x["item"] for x in found.top if x["count"] > HOT_ROWS] if found.n > HOT_ROWS else []


def judged(rows: DataFrame, table: str) -> DataFrame:
    """Rows with status and reason, in silver column order."""
    renamed = rows.withColumnsRenamed({"load_id": "source_load_id", "load_datetime": "source_load_datetime"})
    return classify(renamed, RULES[table]()).select(*SILVER[table].schema.fieldNames())


def build(bronze: DataFrame, table: str) -> DataFrame:
    """Clean, keep the latest, judge: all rows, the rejected ones included."""
    return judged(newest(cleaned(bronze, table), table), table)


def build_stored(bronze: DataFrame, table: str) -> DataFrame:
    """What a load stores: the latest version of every complete key, and every row without one, dealt for storing.

    Rows whose key has a NULL are not versions of each other; all of them are kept for the quarantine. Keys
    are ranked where they are dealt to, so a row moves once and no scan task sorts its rows. Only the rows of a hot key are
    first thinned out by each map task; which keys are taken as hot decides how rows move and never which of them are kept.
    """
    rows, complete, keys = cleaned(bronze, table), complete_key(table), list(SILVER[table].keys)
    hot = hot_keys(rows.where(complete), table)
    known = F.xxhash64(*keys).isin(hot)
    whole = rows.where(complete & ~known) if hot else rows.where(complete)
    placed = whole.withColumn("_slot", slot(keys)).repartition("_slot")
    kept = latest(placed, ["_slot", *keys], _order(rows, table)).drop("_slot")
    if hot:
        kept = kept.unionByName(newest(rows.where(complete & known), table).repartition(slot(keys)))
    apart = rows.where(~complete).repartition(slot(rows.columns))
    return judged(kept.unionByName(apart), table)


def complete_key(table: str) -> Column:
    complete = F.lit(True)
    for key in SILVER[table].keys:
        complete = complete & F.col(key).isNotNull()
    return complete


def accepted(rows: DataFrame) -> DataFrame:
    """The rows that may enter silver."""
    return rows.where(F.col("data_quality_status").isin(VALID, CHECK))


def delivery_measures(orders: DataFrame) -> DataFrame:
    """Delivery columns of silver orders, with days, delay and delivery status."""
    bought, delivered, estimated = F.col(PURCHASE), F.col(CUSTOMER), F.col(ESTIMATE)
    return orders.withColumns(
        {
            "delivery_days": days_between(bought, delivered),
            "delivery_delay_days": days_between(estimated, delivered),
            "delivery_status": delivery_status(delivered, estimated),
        }
    ).select(*SILVER["delivery"].columns, "source_load_id", "source_load_datetime", "source_file")


def build_delivery(orders: DataFrame) -> DataFrame:
    """Judged delivery rows. Silver orders hold each order once, so nothing is deduplicated."""
    rows = classify(delivery_measures(orders), RULES["delivery"]())
    return rows.select(*SILVER["delivery"].schema.fieldNames())
