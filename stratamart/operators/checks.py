"""Validation checks. Each returns a small DataFrame and reads only the columns it tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of same-shape summaries."""
    return reduce(DataFrame.unionByName, frames)


def check_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count."""
    return stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, df in tables.items()
        ]
    )


def check_totals(
    tables: Mapping[str, DataFrame], sums: Mapping[str, Mapping[str, str | None]], kind: str
) -> DataFrame:
    """source_table, row_count and the named sums; a sum without a column comes out as NULL."""
    rows = []
    for label, df in tables.items():
        totals = [
            (F.sum(column) if column else F.lit(None)).cast(kind).alias(name)
            for name, column in sums[label].items()
        ]
        summed = df.agg(F.count(F.lit(1)).alias("row_count"), *totals)
        rows.append(summed.select(F.lit(label).alias("source_table"), "row_count", *sums[label]))
    return stack(rows)


def check_fk(label: str, fact: DataFrame, column: str, dim: DataFrame, key: str, optional: bool = False) -> DataFrame:
    """check_name, invalid_rows: fact rows whose key has no dimension row.

    The fact is first counted per key, with partial counts before the shuffle. Only distinct
    keys travel, a hot key is one row, and the scan reads one column.
    """
    source = fact.where(F.col(column).isNotNull()) if optional else fact
    per_key = source.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    known = dim.select(F.col(key).alias("_key"))
    orphans = per_key.join(known, "_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("invalid_rows")).select(
        F.lit(label).alias("check_name"), "invalid_rows"
    )


def check_links(facts: Sequence[tuple[DataFrame, Sequence[tuple]]], dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """check_name, invalid_rows for all links of several facts, from one scan of each fact and dimension.

    A fact's links are (label, column, dimension, optional); an optional link tests only keys that are there. A fact
    row becomes a short row for each link, counted per link and key before any shuffle, so a hot key is one row for
    each task, and what is left meets one stacked table of all dimensions' keys.
    """
    counted = []
    for rows, links in facts:
        each = [
            F.struct(F.lit(label).alias("check_name"), F.lit(dim).alias("_dim"), F.col(column).cast("bigint").alias("_key"), F.lit(optional).alias("_optional"))
            for label, column, dim, optional in links
        ]
        linked = rows.select(F.explode(F.array(*each)).alias("_link")).select("_link.*").where("_key IS NOT NULL OR NOT _optional")
        counted.append(linked.groupBy("check_name", "_dim", "_key").agg(F.count(F.lit(1)).alias("_rows")))
    known = stack([dim.select(F.lit(name).alias("_dim"), F.col(key).cast("bigint").alias("_key")) for name, (dim, key) in dims.items()])
    orphans = stack(counted).join(known, ["_dim", "_key"], "left_anti").groupBy("check_name").agg(F.sum("_rows").alias("_rows"))
    labels = [(label,) for _, links in facts for label, *_ in links]
    names = facts[0][0].sparkSession.createDataFrame(labels, "check_name string")
    return names.join(orphans, "check_name", "left").select("check_name", F.coalesce("_rows", F.lit(0)).alias("invalid_rows"))


def check_grain(label: str, fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """fact_table, total_rows, distinct_grain; rows are pre-counted per key before the final sums."""
    per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_grain"),
    ).select(F.lit(label).alias("fact_table"), "total_rows", "distinct_grain")


def check_unique(label: str, dim: DataFrame, key: str) -> DataFrame:
    """dimension_name, duplicate_count: rows minus distinct keys (NULL is not a key)."""
    per_key = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    rows = F.coalesce(F.sum("_rows"), F.lit(0))
    return per_key.agg((rows - F.count(key)).alias("duplicate_count")).select(
        F.lit(label).alias("dimension_name"), "duplicate_count"
    )


def duplicate_keys(label: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """contract, violations: keys held by more than one row."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return per_key.agg(F.count_if(F.col("_rows") > 1).alias("violations")).select(
        F.lit(label).alias("contract"), "violations"
    )


def check_not_null(label: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """table_name, column_name, null_rows for every listed column, from one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
        )
    )
    return counted.select(pairs.alias("_pair")).select(
        F.lit(label).alias("table_name"), "_pair.column_name", "_pair.null_rows"
    )


def check_length(label: str, df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """table_name, column_name, long_rows: values over the declared length, from one scan."""
    counted = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("long_rows")) for c in limits])
    )
    return counted.select(pairs.alias("_pair")).select(
        F.lit(label).alias("table_name"), "_pair.column_name", "_pair.long_rows"
    )


def status_counts(tables: Mapping[str, DataFrame], by: str = "data_quality_status") -> DataFrame:
    """table_name, status, row_count."""
    return stack(
        [
            df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), by, "row_count")
            for name, df in tables.items()
        ]
    )


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """rows_rejected: rows of a dimension source without a business key."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("rows_rejected"))
