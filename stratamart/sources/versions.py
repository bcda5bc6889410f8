"""Keyed tables in versions, each of which holds what one load brought.

Nothing that is stored is written again. What a load replaces is marked beside its own version: for each file of
an older version a bitmap of the positions that are no longer current. A reader drops marked rows, so of
each key exactly one row is left, and neither sorts nor shuffles the table for it. The bitmaps are broadcast if
all of them together are at most MARKS_BROADCAST, which their number in the commits tells; beyond that
Spark joins them like any table.

Beside each version lie Bloom filters of its keys, in pages: the leading bits of a key's hash name a page of as many
bits as hold KEYS_PER_PAGE keys, kept for each file that has keys of the page. A load writes its rows dealt by the same
hash, so a page has few files. A later load probes its keys in the pages and reads only the files that may hold
one of them; a page that says so wrongly costs a read and changes nothing, as keys are then joined.
"""

from __future__ import annotations

import json
from decimal import Decimal
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.schemas import LONG, TEXT, TOTAL, table
from stratamart.sources import tables
from stratamart.sources.files import remove
from stratamart.sources.ledger import no_rows
from stratamart.sources.tables import PACKED

REPLACED, STALE, UPDATED = "replaced", "stale", "updated"
#: Rows of a file that one bitmap covers: as many as Spark's bitmaps have bits.
BUCKET = 1 << 15
#: Words of 64 bits that one row of a bitmap in the making holds.
BLOCK_WORDS = 16
MARKS_BROADCAST = 64 << 20
KEYS_PER_PAGE, PROBES = 3_000, 4
#: An increment with more than this share of the stored keys reads all files without asking the filters.
MOST_PROBED = 1 / 8
PLACE = ("_version", "_part", "_file", "_row")
_BITS = T.StructField("bits", T.BinaryType())
_MARKS = T.StructType([*table(kind=TEXT, m_version=LONG, m_part=TEXT, m_file=TEXT, m_bucket=LONG).fields, _BITS])
_PAGES = T.StructType([*table(depth=T.IntegerType(), page=LONG, f_part=TEXT, f_file=TEXT).fields, _BITS])


def notes(commit: Row | None) -> dict:
    """What a commit says of its version: numbers of rows, marks and bits of a page's name."""
    return {k: v for k, v in json.loads(commit.seen or "{}").items() if k.startswith("_")} if commit else {}


def sources(commit: Row) -> dict:
    """The rest of a commit's notes: what its load had seen of other tables."""
    return {k: v for k, v in json.loads(commit.seen or "{}").items() if not k.startswith("_")}


def signed_totals(parts: list[DataFrame], columns: tuple[str, ...]) -> dict[str, dict[str, str]]:
    """Rows and sums by part of rows that count with their sign; numbers as text, as JSON has no exact ones."""
    rows = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(F.col("sign") * F.col(c)).cast(TOTAL).alias(c) for c in columns]
    found = rows.groupBy("_part").agg(F.sum("sign").cast(TOTAL).alias("rows"), *sums).collect()
    return {r["_part"]: {c: str(r[c]) for c in ("rows", *columns) if r[c] is not None} for r in found}


def folded_totals(versions: list[Row]) -> dict[tuple[str, str], Decimal]:
    """The totals of a table's current versions, by part and measure."""
    out: dict[tuple[str, str], Decimal] = {}
    for commit in versions:
        for part, values in notes(commit).get("_totals", {}).items():
            for measure, value in values.items():
                out[part, measure] = out.get((part, measure), Decimal(0)) + Decimal(value)
    return out


def bit(bits: str, position: str) -> Column:
    """Whether a bitmap has the bit at a position; bytes from the left, bits from the right."""
    byte = f"cast(conv(hex(substring({bits}, cast(({position}) div 8 as int) + 1, 1)), 16, 10) as int)"
    return F.expr(f"shiftright({byte}, cast(({position}) % 8 as int)) % 2 = 1")


def bitmaps(rows: DataFrame, at: list[str], position: str) -> DataFrame:
    """A row for each group of `at` with the bitmap `bits` of the positions, below BUCKET, that its rows have.

    Bits are put together by a hash aggregate in blocks of BLOCK_WORDS words, so what a task holds grows with the bitmaps and not
    with the rows. Spark's own aggregate for bitmaps would sort a row for each position, and spill.
    """
    # the first byte of a word is the highest of its number, as hex() writes it
    spread = rows.select(*at, F.expr(f"cast({position} as int)").alias("_at")).select(
        *at,
        F.expr(f"_at div {64 * BLOCK_WORDS}").cast("int").alias("_block"),
        F.expr(f"(_at div 64) % {BLOCK_WORDS}").cast("int").alias("_word"),
        F.expr("shiftleft(1L, (_at & 63) ^ 56)").alias("_bit"),
    )
    words = [F.bit_or(F.when(F.col("_word") == i, F.col("_bit")).otherwise(F.lit(0).cast("long"))).alias(f"_w{i}") for i in range(BLOCK_WORDS)]
    blocks = spread.groupBy(*at, "_block").agg(*words)
    packed = F.unhex(F.concat(*(F.lpad(F.hex(f"_w{i}"), 16, "0") for i in range(BLOCK_WORDS))))
    listed = blocks.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("_block", packed.alias("_bytes")))).alias("_blocks"))
    gap = "x._block - if(i = 0, -1, _blocks[i - 1]._block) - 1"
    joined = f"array_join(transform(_blocks, (x, i) -> concat(repeat('0', {16 * BLOCK_WORDS} * ({gap})), hex(x._bytes))), '')"
    return listed.select(*at, F.expr(f"unhex(rpad({joined}, {BUCKET // 4}, '0'))").alias("bits"))


def slot(keys: list[str]) -> Column:
    """One of 4,096 places that rows are dealt to by the hash of their keys; the leading bits of it name their page."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 52)


def _page(depth: int) -> Column:
    return F.shiftrightunsigned("_hash", 64 - depth) if depth else F.lit(0).cast("long")


def _probe(i: int) -> Column:
    """The i-th of PROBES places of a key within its page."""
    return F.shiftrightunsigned(F.xxhash64("_hash", F.lit(1)), 15 * i).bitwiseAND(BUCKET - 1)


class Versions:
    """One table: its data, marks and key filters, below `root`."""

    def __init__(self, spark: SparkSession, root: str, layer: str, name: str, schema: T.StructType, keys: tuple[str, ...], part: str | None = None, live: tuple[str, ...] = ()):
        """Rows lie in folders by `part`, if given; only those of the `live` parts are the table's."""
        self.spark, self.schema, self.keys, self.part, self.live = spark, schema, list(keys), part, live
        self.folder = f"{root}/{layer}/{name}"
        self.marks_folder, self.filters_folder, self.matches_folder = (f"{root}/{x}/{layer}_{name}" for x in ("marks", "filters", "staging/matches"))

    # -- readers -------------------------------------------------------------------------------

    def stored(self, versions: list[Row], files: list[str] | None = None, place: bool = True) -> DataFrame:
        """The rows as they lie in the versions, or in some of their files, with their part and, if wanted, the rest of their place."""
        layout = T.StructType([*self.schema.fields, T.StructField("version", LONG)])
        paths = tables.folders(self.folder, versions) if files is None else files
        if not paths:
            place = table(_version=LONG, _part=TEXT, _file=TEXT, _row=LONG)
            return no_rows(self.spark, T.StructType([*self.schema.fields, *place.fields]))
        rows = self.spark.read.schema(layout).option("basePath", self.folder).parquet(*paths)
        part = F.col(self.part) if self.part else F.lit("")
        lies = {"_version": F.col("version"), "_part": part, "_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")}
        return rows.select(*self.schema.fieldNames(), *(c.alias(x) for x, c in lies.items() if place or x == "_part"))

    def current(self, versions: list[Row], files: list[str] | None = None, place: bool = True) -> DataFrame:
        """The rows that no later load replaced and that were not older than what they met."""
        marks = self.marks(versions, REPLACED, STALE)
        rows = self.stored(versions, files, place or marks is not None)
        return self._without(rows.where(F.col("_part").isin(*self.live)) if self.live else rows, marks)

    def marks(self, versions: list[Row], *kinds: str) -> DataFrame | None:
        """The bitmaps that these versions brought, None if there are none."""
        marking = [c for c in versions if notes(c).get("_marks")]
        if not marking:
            return None
        layout = T.StructType([*_MARKS.fields, T.StructField("version", LONG)])
        found = self.spark.read.schema(layout).option("basePath", self.marks_folder).parquet(*tables.folders(self.marks_folder, marking))
        found = found.where(F.col("kind").isin(*kinds)).withColumnRenamed("version", "marked_by")
        size = sum(notes(c)["_marks"] for c in marking) * (BUCKET // 8)
        return F.broadcast(found) if size <= MARKS_BROADCAST else found

    @staticmethod
    def _marked() -> Column:
        same = (F.col("_version") == F.col("m_version")) & (F.col("_part") == F.col("m_part")) & (F.col("_file") == F.col("m_file"))
        return same & (F.floor(F.col("_row") / BUCKET) == F.col("m_bucket")) & bit("bits", f"_row % {BUCKET}")

    def _without(self, rows: DataFrame, marks: DataFrame | None) -> DataFrame:
        return rows if marks is None else rows.join(marks, self._marked(), "left_anti")

    def brought(self, versions: list[Row]) -> DataFrame:
        """What these versions brought, stale rows left out; `_new` where the key was not there before."""
        rows = self._without(self.stored(versions), self._own(versions, STALE))
        updated = self._own(versions, UPDATED)
        if updated is None:
            return rows.withColumn("_new", F.lit(True))
        return rows.join(updated, self._marked(), "left").withColumn("_new", F.col("m_file").isNull()).select(*rows.columns, "_new")

    def _own(self, versions: list[Row], kind: str) -> DataFrame | None:
        """Marks that the versions have of their own rows: one bitmap at most covers a row."""
        found = self.marks(versions, kind)
        return None if found is None else found.where("marked_by = m_version")

    # -- key filters ---------------------------------------------------------------------------

    def files_with(self, keys: DataFrame, n: int, versions: list[Row]) -> list[str] | None:
        """The files that may hold one of n keys; None if that may well be all of them.

        `keys` should be a small stored table. The list has at most all files of the versions.
        """
        filtered = [c for c in versions if notes(c).get("_rows")]
        if n > MOST_PROBED * sum(notes(c)["_rows"] for c in filtered):
            return None
        depths = sorted({notes(c)["_depth"] for c in filtered})
        pages = F.explode(F.array(*(F.struct(F.lit(d).alias("depth"), _page(d).alias("page")) for d in depths)))
        hashed = keys.select(F.xxhash64(*self.keys).alias("_hash")).select("_hash", *(_probe(i).alias(f"p{i}") for i in range(PROBES)), pages.alias("at"))
        probes = hashed.select("at.*", *(f"p{i}" for i in range(PROBES)))
        layout = T.StructType([*_PAGES.fields, T.StructField("version", LONG)])
        found = self.spark.read.schema(layout).option("basePath", self.filters_folder).parquet(*tables.folders(self.filters_folder, filtered))
        hits = found.join(probes, ["depth", "page"])
        for i in range(PROBES):
            hits = hits.where(bit("bits", f"p{i}"))
        named = hits.select("version", "f_part", "f_file").distinct().collect()
        part = f"{self.part}={{}}/" if self.part else "{}"
        return sorted(f"{self.folder}/version={r.version}/{part.format(r.f_part)}{r.f_file}" for r in named)

    def _write_filters(self, version: int, rows: DataFrame, n: int) -> int:
        """Filters for the keys of n stored rows; how many bits name a page."""
        depth = max(0, ceil(log2(max(n, 1) / KEYS_PER_PAGE)))
        probes = F.explode(F.array(*(_probe(i) for i in range(PROBES)))).alias("probe")
        hashed = rows.select("_part", "_file", F.xxhash64(*self.keys).alias("_hash"))
        spread = hashed.select(_page(depth).alias("page"), F.col("_part").alias("f_part"), F.col("_file").alias("f_file"), probes)
        pages = bitmaps(spread, ["page", "f_part", "f_file"], "probe")
        pages.select(F.lit(depth).alias("depth"), "page", "f_part", "f_file", "bits").write.options(**PACKED).mode("overwrite").parquet(f"{self.filters_folder}/version={version}")
        return depth

    # -- writers -------------------------------------------------------------------------------

    def write(self, rows: DataFrame, version: int, dealt: bool = False) -> DataFrame:
        """Write a version, dealt by the hash of its keys unless that is done; the rows as they lie there.

        Rows without a whole key are dealt by all their columns, so that they don't meet in one file.
        """
        whole = F.lit(True)
        for key in self.keys:
            whole = whole & F.col(key).isNotNull()
        place = F.when(whole, slot(self.keys)).otherwise(slot(rows.columns))
        writer = (rows if dealt else rows.repartition(place)).write.options(**PACKED).mode("overwrite")
        (writer.partitionBy(self.part) if self.part else writer).parquet(f"{self.folder}/version={version}")
        return self.stored([Row(version=version)])

    def mark(self, version: int, places: DataFrame) -> tuple[int, dict[str, int]]:
        """Store marks for (kind, *PLACE); the number of bitmaps and of rows of each kind."""
        bucket = F.floor(F.col("_row") / BUCKET).cast("long")
        found = places.select("kind", *(F.col(f"_{x}").alias(f"m_{x}") for x in ("version", "part", "file")), bucket.alias("m_bucket"), "_row")
        bits = bitmaps(found, ["kind", "m_version", "m_part", "m_file", "m_bucket"], f"_row % {BUCKET}")
        folder = f"{self.marks_folder}/version={version}"
        bits.write.options(**PACKED).mode("overwrite").parquet(folder)
        written = self.spark.read.schema(_MARKS).parquet(folder)
        counts = written.groupBy("kind").agg(F.count("*").alias("bitmaps"), F.sum(F.bitmap_count("bits")).alias("rows")).collect()
        return sum(r.bitmaps for r in counts), {r.kind: r.rows for r in counts}

    def settle(self, version: int, own: DataFrame, n: int, versions: list[Row], newer: str, totals: tuple[str, ...] = ()) -> tuple[dict, int, int]:
        """Mark what the n stored rows `own` of a new version replace and which of them are not newer than what is there.

        Gives the notes for the commit, and how many rows replaced one and how many were stale. The notes have
        what the version adds to the rows and to the sums of `totals`, by part: its own rows less the stale and
        the replaced ones. So the totals of a table are sums over its commits, in any order.
        """
        marks, kinds, added = 0, {}, [own.select("_part", F.lit(1).alias("sign"), *totals)]
        folder = f"{self.matches_folder}/version={version}" if versions and n else None
        if folder:
            of_old = {x: f"old{x}" for x in (*PLACE, *totals)}
            held = self._held(own, n, versions).select(*self.keys, F.col(newer).alias("_held"), *(F.col(x).alias(y) for x, y in of_old.items()))
            both = own.select(*self.keys, newer, *PLACE, *totals).join(held, self.keys)
            won = F.col(newer) > F.col("_held")
            both.select(won.alias("won"), *PLACE, *totals, *of_old.values()).write.options(**PACKED).mode("overwrite").parquet(folder)
            both = self.spark.read.parquet(folder)

            def place(kind: str, before: str = "") -> Column:
                return F.struct(F.lit(kind).alias("kind"), *(F.col(before + x).alias(x) for x in PLACE))

            found = both.select(F.explode(F.when(F.col("won"), F.array(place(UPDATED), place(REPLACED, "old"))).otherwise(F.array(place(STALE)))).alias("at"))
            marks, kinds = self.mark(version, found.select("at.*"))
            gone = [F.when(F.col("won"), F.col(y)).otherwise(F.col(x)).alias(x) for x, y in of_old.items() if x == "_part" or x in totals]
            added.append(both.select(F.lit(-1).alias("sign"), *gone))
        depth = self._write_filters(version, own, n) if n else 0
        noted = {"_marks": marks, "_rows": n, "_depth": depth, "_totals": signed_totals(added, totals)}
        if folder:
            remove(self.spark, folder)
        return noted, kinds.get(UPDATED, 0), kinds.get(STALE, 0)

    def _held(self, keys: DataFrame, n: int, versions: list[Row]) -> DataFrame:
        """Current rows, only from files that may hold one of the n keys."""
        return self.current(versions, self.files_with(keys, n, versions))
