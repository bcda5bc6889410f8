"""I-Match fingerprints with randomised lexicons.

The lexicon holds the terms whose share of documents lies in a chosen band, that is, whose inverse
document frequency does. Each of LEXICONS random lexicons is a series of subsets, each of which
keeps about half of the terms of the one before. A text is read through the narrowest subset in
which it still has a term: its distinct terms there, sorted, are hashed. So every text, short or
long, gives one hash per lexicon, and the likeness of two fingerprints is the share of equal hashes.

Documents are dealt by ranges of doc_id, so that the next document, in ascending order, is in the same range; the first
document of a range is also added to the range before it.

The lexicon has at most (mean distinct terms of a document) / MIN_SHARE terms, since each takes up
MIN_SHARE of all documents. It is broadcast only if it was counted to have at most MAX_BROADCAST
terms, else joined.

Defined cases: null is the empty text; a text without a term of the lexicon is represented by the
hash of all its terms, or of the text itself where it has none, in every place; the document after
the last is the first, and a lone document follows itself; rows without doc_id form a series of
their own, by text, whose last row is followed by an empty text; repeated rows follow each other;
other columns are not read. All expressions are Spark's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import partitions, written

LEXICONS = 16
MIN_SHARE, MAX_SHARE = 0.001, 0.05
MAX_BROADCAST = 1_000_000
_LEVEL_BITS = 4
_IN_TEXT, _IN_EDITED = 1, 2


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct terms: runs of letters and digits in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)), lambda x: F.xxhash64(x)))


def lexicon(docs: DataFrame, low: float = MIN_SHARE, high: float = MAX_SHARE) -> DataFrame:
    """The terms of the band: their hash and, packed, the narrowest subset of each lexicon that keeps them."""
    n = docs.count()
    frequency = docs.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").count()
    band = frequency.where(F.col("count").between(low * n, max(1.0, high * n)))
    packed = F.lit(0).cast("long")
    for k in range(LEXICONS):
        bits = F.xxhash64("term", F.lit(k)).bitwiseOR(F.lit(1 << (1 << _LEVEL_BITS) - 1))
        level = F.bit_count(bits.bitwiseAND(-bits) - 1).cast("long")  # trailing zero bits: each level keeps half
        packed = packed.bitwiseOR(F.shiftleft(level, _LEVEL_BITS * k))
    return band.select("term", packed.alias("levels"))


def _range(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most doc_id, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    values = F.array(*map(F.lit, bounds))

    def step(at: Column, width: Column) -> Column:
        reached = at + width
        return F.when((reached <= len(bounds)) & (F.get(values, F.least(reached, F.lit(len(bounds))) - 1) <= doc_id), reached).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def in_ranges(docs: DataFrame) -> DataFrame:
    """bucket, row (place in the bucket), ghost (true for a copy of the next bucket's first document), doc_id, text, next_text."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    shares = [i / n for i in range(1, n)]
    bounds = docs.select(F.percentile_approx("doc_id", shares)).first()[0] if shares else None  # n - 1 numbers
    bounds = sorted(set(bounds or []))
    own = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_range(F.col("doc_id"), bounds)))
    # one row for each bucket
    firsts = own.where("bucket >= 0").groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    around = Window.orderBy("bucket")
    firsts = firsts.select("first_id", F.coalesce(F.lag("bucket").over(around), F.max("bucket").over(Window.partitionBy())).alias("bucket"))
    ghosts = docs.join(F.broadcast(firsts), F.col("doc_id") == F.col("first_id")).select("doc_id", "text", "bucket", F.lit(True).alias("ghost"))
    # each range to a task of its own: by hash, several would meet in one
    dealt = own.withColumn("ghost", F.lit(False)).unionByName(ghosts).repartitionById(n, F.col("bucket"))
    order = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    return dealt.select("*", F.row_number().over(order).alias("row"), F.lead("text", 1, "").over(order).alias("next_text"))


def edited_text() -> Column:
    """The last quarter of the code points, rounded down, replaced by as many from the start of the next text."""
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    return F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut))


def _whole(terms: str, text: str) -> Column:
    return F.when(F.size(terms) == 0, F.xxhash64(text)).otherwise(F.xxhash64(F.sort_array(terms)))


def _tagged(terms: Column, version: int) -> Column:
    return F.transform(terms, lambda x: F.struct(x.alias("term"), F.lit(version).alias("version")))


def _subset_hashes(rows: DataFrame) -> DataFrame:
    """For each text and lexicon, the hash of the sorted terms in the narrowest subset that has any.

    Slots 0 to LEXICONS - 1 are those of the text, the next ones those of the edited text; slot -1
    carries the text's facts.
    """
    of_text, slots = Window.partitionBy("bucket", "row"), [F.when(F.col("term").isNull(), F.lit(-1))]
    for part, version in enumerate((_IN_TEXT, _IN_EDITED)):
        here = F.col("version").bitwiseAND(version) != 0
        for k in range(LEXICONS):
            level = F.shiftrightunsigned("levels", _LEVEL_BITS * k).bitwiseAND((1 << _LEVEL_BITS) - 1)
            narrowest = F.max(F.when(here, level)).over(of_text)
            slots.append(F.when(here & (level == narrowest), F.lit(part * LEXICONS + k)))
    kept = rows.select("bucket", "row", "term", "facts", F.array_compact(F.array(*slots)).alias("slots"))
    kept = kept.select("bucket", "row", "term", "facts", F.explode("slots").alias("slot"))
    hashed = F.xxhash64(F.sort_array(F.collect_list("term"))).alias("hash")
    return kept.groupBy("bucket", "row", "slot").agg(hashed, F.first("facts", ignorenulls=True).alias("facts"))


def _of_part(part: int, whole: str) -> Column:
    own = F.filter("hashes", lambda x: (x["slot"] >= part * LEXICONS) & (x["slot"] < (part + 1) * LEXICONS))
    return F.when(F.size(own) == 0, F.array_repeat(F.col(whole), LEXICONS)).otherwise(F.transform(own, lambda x: x["hash"]))


def _hex(hashes: str) -> Column:
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def likeness(one: str, other: str) -> Column:
    """Share of the places where two fingerprints, as arrays, are equal."""
    same = F.zip_with(one, other, lambda a, b: (a.bitwiseAND(0xFFFFFFFF) == b.bitwiseAND(0xFFFFFFFF)).cast("int"))
    return F.aggregate(same, F.lit(0), lambda total, x: total + x) / F.lit(float(LEXICONS))


def fingerprints(docs: DataFrame, low: float = MIN_SHARE, high: float = MAX_SHARE) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses."""
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    band = written(lexicon(filled, low, high), "lexicon")
    if band.count() <= MAX_BROADCAST:
        band = F.broadcast(band)
    texts = in_ranges(filled).withColumn("edited", edited_text())
    texts = texts.withColumn("t", term_hashes(F.col("text"))).withColumn("e", term_hashes(F.col("edited")))
    kinds = {_IN_TEXT | _IN_EDITED: F.array_intersect("t", "e"), _IN_TEXT: F.array_except("t", "e"), _IN_EDITED: F.array_except("e", "t")}
    tagged = [_tagged(x, version) for version, x in kinds.items()]
    facts = F.struct(
        "ghost", "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        _whole("t", "text").alias("whole"), _whole("e", "edited").alias("edited_whole"),
    )
    # the first row of each text has its facts and no term, so that the others stay narrow
    head = F.array(F.struct(F.lit(None).cast("long").alias("term"), F.lit(0).alias("version")))
    rows = texts.select("bucket", "row", facts.alias("facts"), F.explode(F.concat(head, *tagged)).alias("found"))
    rows = rows.select("bucket", "row", "found.*", F.when(F.col("found.term").isNull(), F.col("facts")).alias("facts"))
    rows = rows.join(band, "term", "left").where("term is null or levels is not null")
    hashes = F.sort_array(F.collect_list(F.struct("slot", "hash"))).alias("hashes")
    texts = _subset_hashes(rows).groupBy("bucket", "row").agg(F.first("facts", ignorenulls=True).alias("facts"), hashes)
    texts = texts.select("bucket", "row", "facts.*", "hashes")
    texts = texts.withColumn("own", _of_part(0, "whole")).withColumn("changed", _of_part(1, "edited_whole"))
    after = F.lead("own").over(Window.partitionBy("bucket").orderBy("row"))
    texts = texts.select("ghost", "doc_id", "n_chars", "edited_sha256", "own", "changed", F.coalesce(after, F.array(*[F.xxhash64(F.lit(""))] * LEXICONS)).alias("after"))
    return texts.where("not ghost").select(
        "doc_id", "n_chars", "edited_sha256",
        _hex("own").alias("fingerprint"), _hex("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "after").alias("near_next"),
    )
