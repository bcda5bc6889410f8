"""Cross-site boilerplate lines, by the number of distinct sites that hold a line.

Lines are split at line feeds and compared by a 64-bit hash of the line without white space at its
ends. The distinct (line, site) pairs feed one HyperLogLog sketch per line, merged by aggregation
before and after the shuffle. Lines whose estimate is near the threshold get an exact distinct
count; lines on at least MIN_SITES sites leave all documents.

Defined cases: blank lines are neither counted nor removed; a null source is no site; null texts stay null and
have no lines; a document may end up empty but stays; repeated rows are all kept and treated alike;
other columns pass. All expressions are Spark's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import written

MIN_SITES = 10
LG_CONFIG_K = 12
#: Six standard errors of a sketch, as a share, and at least one site: beyond them the estimate decides.
NEAR_SHARE = 6 * 1.04 / 2 ** (LG_CONFIG_K / 2)
_SPACE = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _plain(line: Column) -> Column:
    return F.btrim(line, F.lit(_SPACE))


def line_sites(docs: DataFrame) -> DataFrame:
    """Distinct pairs of a line's hash and a site."""
    lines = docs.select(F.col("source").alias("site"), F.explode(_lines(F.col("text"))).alias("line"))
    lines = lines.where(_plain(F.col("line")) != "").where("site is not null")
    return lines.select(F.xxhash64(_plain(F.col("line"))).alias("line_hash"), "site").distinct()


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of the lines on at least `min_sites` sites."""
    pairs = written(line_sites(docs), "line-sites")
    spread = pairs.groupBy("line_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_CONFIG_K)).alias("sites"))
    margin = max(1.0, NEAR_SHARE * min_sites)
    spread = written(spread.where(F.col("sites") >= min_sites - margin), "line-spread")
    near = spread.where(F.col("sites") <= min_sites + margin).select("line_hash")
    exact = pairs.join(near, "line_hash").groupBy("line_hash").agg(F.count("site").alias("sites"))
    far = spread.where(F.col("sites") > min_sites + margin).select("line_hash")
    return far.unionByName(exact.where(F.col("sites") >= min_sites).select("line_hash"))


def marked(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents with `__found`, the hashes of their boilerplate lines (null: none)."""
    own = docs.select(F.col("doc_id").alias("__id"), F.explode(_lines(F.col("text"))).alias("line"))
    own = own.where(_plain(F.col("line")) != "").select("__id", F.xxhash64(_plain(F.col("line"))).alias("line_hash")).distinct()
    # a document's own lines bound the size of its set
    found = own.join(boilerplate(docs, min_sites), "line_hash").groupBy("__id").agg(F.collect_set("line_hash").alias("__found"))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__id"]), "left").drop("__id")


def _stays(line: Column) -> Column:
    return ~F.coalesce(F.array_contains("__found", F.xxhash64(_plain(line))), F.lit(False)) | (_plain(line) == "")


def cleaned_text() -> Column:
    return F.when(F.col("__found").isNull(), F.col("text")).otherwise(F.array_join(F.filter(_lines(F.col("text")), _stays), "\n"))


def cleaned(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The documents without boilerplate lines; n_chars is set anew where there is such a column."""
    new = marked(docs, min_sites).withColumn("text", cleaned_text()).drop("__found")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return new.select(docs.columns)


def line_counts(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """For each document: lines that aren't blank, those removed, and the digest of what stays (null text: empty)."""
    filled = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(_lines(F.col("text")), lambda x: _plain(x) != "")
    return marked(filled, min_sites).select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: ~_stays(x))).cast("long").alias("n_removed"),
        F.sha2(cleaned_text().cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
lines AS (SELECT source, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM docs),
common AS (SELECT list(line) AS found FROM (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES})),
split AS (
  SELECT doc_id, string_split(text, chr(10)) AS own, coalesce(found, []) AS found FROM docs, common
),
judged AS (
  SELECT doc_id,
    [x FOR x IN own IF trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''] AS full_lines,
    [x FOR x IN own IF NOT list_contains(found, trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)))] AS kept,
    len(own) AS n_own
  FROM split
)
SELECT doc_id, len(full_lines)::BIGINT AS n_lines, (n_own - len(kept))::BIGINT AS n_removed,
  sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM judged
"""
