"""Near duplicates of word shingles by bottom-k sketches from one hash function.

A text's set is the 64-bit hashes of its distinct shingles. Texts of equal words (A-Z lowered) are one
text, named `copy` by a hash of 64 bits, until the end.

Retained values. Shingles are put in one order: rare ones first, by the class of a counter that their
hash falls in (COUNTERS counters, counted over all texts, the power of two of the count is the class),
then by hash. A text of n shingles retains the bottom floor(n / 5) + 1. Two sets with 5 * intersection >=
4 * union have a common value among those of both, whatever the order, so the inverted lists
of the retained values hold every link; the counters only keep frequent passages out of them.

Overlaps. Values that two texts retain give candidates, if sizes, places and marks leave a link possible. In a list
of at most SMALL texts all such pairs are candidates. In a longer list, each text is held against one hub of the
list; then, round by round, against new hubs in another component than its own. When few pairs remain that
lie in two components, or hubs link few more, exactly those are taken. Only which texts belong together is asked for,
so pairs within a component needn't be compared, and none that could join two components is left out.

Estimates. A text's MARKS marks are a bit each of the least value under as many orders, and go into the lists with it. Texts that share
a passage or a few words by chance differ in nearly half of their marks, so such pairs never leave their list; at a similarity of
0.8 a tenth differ, and more than MARKS_APART with a chance of 2e-14. The bottom SKETCH hashes, of 32 bits, of a candidate
pair's union are a random sample of it. If less than half of them are shared, the pair is dropped; at a similarity of 0.8
that happens with a chance of 4e-13.

Verification. What is left is compared on the full sets, made from the texts.

Defined cases: a text of fewer words than a shingle is one shingle; a null text is empty; texts without words
are copies of one another, with an empty set that is linked with nothing else; repeated rows each give a row;
rows without doc_id belong to components but never name one; other columns pass or are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import Batches, partitions, text_bytes, written
from stratamart.llm.components import roots

SKETCH = 128
SMALL = 32
MARKS, MARKS_APART = 128, 44
SIEVE = 1 << 26
SEED = 42
COUNTERS, _SLICES = 1 << 23, 64
_SHIFT = np.uint64(41)  # a hash's upper 23 bits are its counter
#: A longer list gets this many new hubs in each further round.
_HUBS = 4
_ORDERS = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 31, MARKS, np.uint32) * np.uint32(2) + np.uint32(1)
_AT_ONCE = 4_096
#: Lists are named by 40 bits of their value; where two share a name, some pairs more are compared.
_LISTED = np.uint64(0xFFFFFFFFFF000000)
_SPLIT = 1_000
_SEEN = 100_000


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """The distinct hashes of all runs of `width` words, ascending."""
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n + j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(29)))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a similarity of 0.8 or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def sketch(values: np.ndarray) -> np.ndarray:
    return np.unique((values[: 2 * SKETCH] >> np.uint64(32)).astype("<u4"))[:SKETCH]


def likely(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether at least half of the bottom of the union is shared."""
    union = np.union1d(a, b)[:SKETCH]
    both = np.intersect1d(a, b, assume_unique=True)
    return 2 * int(np.searchsorted(both, union[-1], "right")) >= len(union) if len(union) else False


def marks(values: np.ndarray) -> np.ndarray:
    """MARKS bits as two signed numbers: of the least value in each order a bit of its hash."""
    own, least = (values >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.full(MARKS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(own), _AT_ONCE):
        np.minimum(least, (own[at : at + _AT_ONCE, None] * _ORDERS).min(0), out=least)
    for factor, shift in ((0x85EBCA6B, 13), (0xC2B2AE35, 16)):
        least = (least ^ (least >> np.uint32(16))) * np.uint32(factor)
        least ^= least >> np.uint32(shift)
    return np.packbits((least & np.uint32(1)).astype(np.uint8), bitorder="little").view("<i8")


def copy_of(words: list[bytes] | bytes) -> int:
    """The hash of the words, in a list or joined by spaces, as a signed number."""
    value = xxhash.xxh3_64_intdigest(words if isinstance(words, bytes) else b" ".join(words), SEED)
    return value - (1 << 64) if value >> 63 else value


def rarity(docs: DataFrame, width: int) -> np.ndarray:
    """The class of each counter, a byte; COUNTERS bytes come to the driver whatever the size of the corpus."""
    per = COUNTERS // _SLICES

    def count(batches: Batches):
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for text in text_bytes(batch):
                np.add.at(counts, (shingles(text.lower().split(), width) >> _SHIFT).astype(np.int64), 1)
        packed = [zlib.compress(np.packbits(x > 0).tobytes() + x[x > 0].tobytes(), 1) for x in counts.reshape(_SLICES, per)]
        yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(packed)], ["slice", "counts"])

    def classed(batches: Batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                data = np.frombuffer(zlib.decompress(packed), np.uint8)
                own = sums.setdefault(at, np.zeros(per, np.int64))
                own[np.unpackbits(data[: per // 8]).astype(bool)] += data[per // 8 :].view(np.uint32)
        classes = [np.frexp(x.astype(np.float64))[1].astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.int32()), pa.array(classes, pa.binary())], ["slice", "classes"])

    slices = docs.select("text").mapInArrow(count, "slice int, counts binary").repartition(_SLICES, "slice")
    found = {r["slice"]: bytes(r["classes"]) for r in slices.mapInArrow(classed, "slice int, classes binary").collect()}
    return np.frombuffer(b"".join(found.get(i, bytes(per)) for i in range(_SLICES)), np.uint8)


def retained(values: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The bottom floor(n / 5) + 1 values, rarest first."""
    order = np.argsort(classes[(values >> _SHIFT).astype(np.int64)], kind="stable")
    return values[order[: len(values) // 5 + 1]]


def _own(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, copy and size of each row's set; marks and retained values where a task meets a copy first."""
    classes = docs.sparkSession.sparkContext.broadcast(rarity(docs, width))

    def run(batches: Batches):
        seen = set()
        for batch in batches:
            copies, sizes, marked, values = [], [], [], []
            for text in text_bytes(batch):
                words = text.lower().split()
                found = shingles(words, width)
                copies.append(copy := copy_of(words))
                sizes.append(len(found))
                first = len(found) > 0 and copy not in seen
                seen.add(copy)
                marked.append(marks(found).tolist() if first else (None, None))
                values.append((retained(found, classes.value) & _LISTED).view(np.int64) if first else None)
            if len(seen) > _SEEN:
                seen.clear()
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(copies, pa.int64()), pa.array(sizes, pa.int64())]
            columns += [pa.array([x[i] for x in marked], pa.int64()) for i in range(2)]
            columns.append(pa.array(values, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "n", "marks", "marks2", "retained"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, copy long, n long, marks long, marks2 long, retained array<long>")


def _sieve(wanted: DataFrame) -> Callable[[np.ndarray], np.ndarray]:
    """Which copies may be wanted: a bit for each, at most SIEVE bits for all; joins need to move few others then."""
    bits = max(64, min(SIEVE, 1 << (16 * wanted.count()).bit_length()))
    at = F.col("copy").bitwiseAND(bits - 1)
    words = wanted.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(copy & 63))")).alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    known = wanted.sparkSession.sparkContext.broadcast(table)

    def passes(copies: np.ndarray) -> np.ndarray:
        at = copies.view(np.uint64) & np.uint64(bits - 1)
        return (known.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    return passes


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """copy and its words, once each, for the wanted copies."""
    passes = _sieve(wanted)

    def run(batches: Batches):
        seen = set()
        for batch in batches:
            joined = [b" ".join(x.lower().split()) for x in text_bytes(batch)]
            copies = np.array([copy_of(x) for x in joined], np.int64)
            found = {}
            for i in np.flatnonzero(passes(copies)).tolist():
                if (copy := int(copies[i])) not in seen:
                    seen.add(copy)
                    found[copy] = joined[i]
            if len(seen) > _SEEN:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.binary())], ["copy", "data"])

    return docs.select("text").mapInArrow(run, "copy long, data binary").join(wanted, "copy", "left_semi").dropDuplicates(["copy"])


def _held(pairs: DataFrame, known: DataFrame, read: Callable, judge: Callable, label: str) -> DataFrame:
    """The pairs (a, b) that `judge` accepts on what `read` makes of the `data` of both copies.

    A task has one a at a time and reads the others beside it; an a with very many is dealt to several tasks.
    """

    def run(batches: Batches):
        own = None
        for batch in batches:
            found = []
            for a, b, data in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "data")), strict=True):
                if b is None:
                    own = read(data)
                elif judge(own, read(data)):
                    found.append((a, b))
            columns = zip(*found, strict=True) if found else [()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["a", "b"])

    parts = F.ceil(F.col("size") / _SPLIT)
    sizes = pairs.groupBy("a").agg(F.count("*").alias("size"))
    dealt = written(pairs.join(sizes, "a").select("a", "b", F.pmod(F.xxhash64("b"), parts).alias("part")), "near-pairs")
    first = dealt.select("a", "part").distinct().join(known, F.col("a") == F.col("copy")).select("a", "part", F.lit(None).cast("long").alias("b"), "data")
    others = dealt.join(known, F.col("b") == F.col("copy")).select("a", "part", "b", "data")
    together = first.union(others).repartition(partitions(pairs.sparkSession), "a", "part").sortWithinPartitions("a", "part", "b")
    return written(together.mapInArrow(run, "a long, b long"), label)


class _Judge:
    """Estimates and verifies candidates, and remembers which were held against each other."""

    def __init__(self, docs: DataFrame, width: int):
        self.docs, self.width, self.done = docs, width, None

    def links(self, candidates: DataFrame) -> DataFrame:
        width = self.width

        def read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
            found = shingles(data.split(), width)
            return sketch(found), found

        new = candidates.distinct()
        if self.done is not None:
            new = new.join(self.done, ["a", "b"], "left_anti")
        new = written(new, "near-candidates")
        self.done = new if self.done is None else self.done.union(new)
        both = written(new.select(F.col("a").alias("copy")).union(new.select("b")).distinct(), "near-wanted")
        texts = written(_texts(self.docs, both), "near-texts")
        return _held(new, texts, read, lambda x, y: likely(x[0], y[0]) and linked(x[1], y[1]), "near-links")


def _of(member: str | Column, *names: str) -> list[Column]:
    """Columns of a row that goes by a name, or fields of a struct."""
    return [F.col(f"{member}.{x}") if isinstance(member, str) else member[x] for x in names]


def _possible(a: str, b: str | Column) -> Column:
    """Whether a pair may be linked if this is its first common value.

    What lies before it isn't shared, so the intersection has at most the rest of the shorter remainder, and 5 * intersection
    >= 4 * union is 9 * intersection >= 4 * (both sizes).
    """
    (n_a, at_a), (n_b, at_b) = _of(a, "n", "place"), _of(b, "n", "place")
    return 9 * F.least(n_a - at_a, n_b - at_b) >= 4 * (n_a + n_b)


def _placed(a: str, b: str) -> Column:
    """Whether a pair may be linked if this is any common value: before it and from it on the lesser number may be shared."""
    (n_a, at_a), (n_b, at_b) = _of(a, "n", "place"), _of(b, "n", "place")
    return 9 * (F.least(at_a, at_b) + F.least(n_a - at_a, n_b - at_b)) >= 4 * (n_a + n_b)


def _alike(a: str, b: str | Column) -> Column:
    """Whether the marks leave a link possible, but for a chance of 2e-14."""
    both = zip(_of(a, "marks", "marks2"), _of(b, "marks", "marks2"), strict=True)
    return sum(F.bit_count(x.bitwiseXOR(y)) for x, y in both) <= MARKS_APART


def _ends(a: str, b: str) -> list[Column]:
    a, b = F.col(f"{a}.copy"), F.col(f"{b}.copy")
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _against_hubs(members: DataFrame, salt: int, hubs: int) -> DataFrame:
    """Each member of a list with the list's hubs, in another component if there are any yet."""
    rooted = "root" in members.columns
    hub = F.struct(F.xxhash64("value", "copy", "salt").alias("by"), "copy", "n", "place", "marks", "marks2", *(["root"] if rooted else []))
    salted = members.withColumn("salt", F.explode(F.array(*(F.lit(salt * _HUBS + i) for i in range(hubs))))) if hubs > 1 else members.withColumn("salt", F.lit(salt * _HUBS))
    least = salted.groupBy("value", "salt").agg(F.min(hub).alias("hub")).select("value", "hub.*").drop("by").distinct()
    pairs = members.alias("x").join(least.alias("y"), "value").where("x.copy <> y.copy" + " and x.root <> y.root" * rooted)
    return pairs.where(_placed("x", "y") & _alike("x", "y")).select(*_ends("x", "y"))  # a hub's value need not be the first in common


def _spread(named: DataFrame) -> tuple[DataFrame, int, int]:
    """Lists whose texts are in several components, each with its largest one; their rows and the pairs apart."""
    parts = named.groupBy("value", "root").agg(F.count("*").alias("k"))
    lists = parts.groupBy("value").agg(F.count("*").alias("roots"), F.sum("k").alias("rows"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.max_by("root", F.struct("k", "root")).alias("largest"))
    lists = written(lists.where("roots > 1"), "near-lists")
    rows, apart = lists.agg(F.sum("rows"), F.sum((F.col("rows").cast("double") ** 2 - F.col("squares")) / 2)).first()
    return lists.select("value", "largest"), rows or 0, apart or 0


def _shared(first: DataFrame) -> DataFrame:
    """Of the retained values of at least two copies: in short lists the rows with the copies before them that may be linked, in
    longer ones all rows.

    Each retained value is moved once; short lists are paired where they lie.
    """
    rows = first.select("copy", "n", "marks", "marks2", F.posexplode("retained").alias("place", "value"))
    packed = F.shiftleft("n", 32).bitwiseOR(F.col("place").cast("long")).alias("packed")  # these rows are most of what is moved
    rows = rows.select(packed, "value", "copy", "marks", "marks2").repartition("value")
    rows = rows.withColumns({"n": F.shiftright("packed", 32), "place": F.col("packed").bitwiseAND(0xFFFFFFFF)}).drop("packed")
    list_of = Window.partitionBy("value")
    counted = rows.withColumns({"size": F.count("*").over(list_of), "least": F.min("copy").over(list_of), "most": F.max("copy").over(list_of)})
    members = counted.where("least <> most").select("value", "copy", "n", "place", "marks", "marks2", (F.col("size") <= SMALL).alias("short")).distinct()
    before = F.collect_list(F.struct("copy", "n", "place", "marks", "marks2")).over(list_of.orderBy("value").rowsBetween(1 - SMALL, -1))
    x = members.withColumn("before", F.when(F.col("short"), before)).alias("x")
    near = F.transform(F.filter("x.before", lambda y: _possible("x", y) & _alike("x", y)), lambda y: y["copy"])
    return x.withColumn("near", near).drop("before").where("not short or size(near) > 0")


def _grouped(given: DataFrame, first: DataFrame, found: DataFrame) -> DataFrame | None:
    """The groups that given pairs name as lists of their own, None if none has pairs beyond those given that are still apart.

    Members need not share a value, so all have the place 0, which leaves the whole set for the intersection. No list's name has the
    last bit that a group's has.
    """
    several = given.groupBy("a").agg(F.count("*").alias("k")).where("k > 1").select("a")
    names = written(_apart(given, found).select("a").distinct().join(several, "a"), "near-groups")
    if not names.take(1):
        return None
    tied = given.join(names, "a")
    value = F.col("a").bitwiseOR(1).alias("value")
    members = tied.select(value, F.col("b").alias("copy")).union(tied.select(value, "a")).distinct()
    known = first.select("copy", "n", "marks", "marks2").join(members.select("copy"), "copy", "left_semi").dropDuplicates(["copy"])
    return written(members.join(known, "copy").select("value", "copy", "n", F.lit(0).cast("long").alias("place"), "marks", "marks2"), "near-grouped")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    for end in ("a", "b"):
        pairs = pairs.join(found.toDF(end, f"{end}_root"), end, "left")
    return pairs.where("coalesce(a_root, a) <> coalesce(b_root, b)").select("a", "b")


def _components(docs: DataFrame, own: DataFrame, width: int, given: DataFrame | None = None) -> DataFrame:
    """(node, root) of all copies that are linked but the roots.

    Given pairs (a, b) of copies are held against each other first; those with the same a are a group, of which further rounds
    compare all pairs that are still in two components, as in a long list.
    """
    first = own.where("retained is not null")
    shared = written(_shared(first), "near-shared")
    judge = _Judge(docs, width)
    found = shared.where("short").select("copy", F.explode("near").alias("other"))
    pairs, large = found.select(F.least("copy", "other").alias("a"), F.greatest("copy", "other").alias("b")), shared.where("not short").drop("short", "near")
    pairs = pairs.union(_against_hubs(large, 0, 1))
    if given is None:
        found = written(roots(judge.links(pairs)), "near-roots")
    else:
        links = judge.links(given)
        links = links.union(judge.links(_apart(pairs.distinct(), roots(links))))
        found = written(roots(links), "near-roots")
        groups = _grouped(given, first, found)
        large = large if groups is None else large.union(groups)

    turn, joined = 0, None
    while True:
        root, turn = found.withColumnRenamed("node", "copy"), turn + 1
        named = written(large.join(root, "copy", "left").withColumn("root", F.coalesce("root", "copy")), "near-named")
        lists, n_rows, apart = _spread(named)
        if not apart:
            return found
        here = named.join(lists, "value")
        last = apart <= 2 * n_rows or (joined is not None and 100 * joined < n_rows)
        if last:
            strays = here.where("root <> largest")  # a pair of two strays comes up twice, which distinct() undoes
            rest = strays.alias("x").join(here.alias("y"), "value").where("x.root <> y.root").where(_possible("x", "y") & _alike("x", "y"))
            new = judge.links(rest.select(*_ends("x", "y")))
        else:
            new = judge.links(_against_hubs(here, turn, _HUBS))
        joined = new.count()
        if joined:
            found = written(roots(new.union(found.select(F.col("node").alias("a"), F.col("root").alias("b")))), "near-roots")
        if last:
            return found


def components(docs: DataFrame, width: int, given: DataFrame | None = None) -> DataFrame:
    """doc_id, n_shingles, copy, root (the component's own name) and component_id, the least doc_id that can be reached over links.

    Groups that another method gives, as pairs (a, b) of one member and each other, are verified like all candidates: the pairs
    given before the lists, the other pairs of a group with the lists.
    """
    own = written(_own(docs, width), "near-own")
    firsts = written(own.groupBy("copy").agg(F.min("doc_id").alias("first_id")), "near-ids")
    found = _components(docs, own, width, given)
    members = found.union(found.select("root", "root").distinct()).join(firsts, F.col("node") == F.col("copy"))
    least = members.groupBy("root").agg(F.min("first_id").alias("least_id"))
    named = members.join(least, "root").select("copy", "root", "least_id")
    names = firsts.join(named, "copy", "left").select("copy", F.coalesce("root", "copy").alias("root"), F.coalesce("least_id", "first_id").alias("component_id"))
    return own.select("doc_id", F.col("n").alias("n_shingles"), "copy").join(names, "copy").select("doc_id", "n_shingles", "copy", "root", "component_id")


def near_duplicates(docs: DataFrame, width: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id and kept; a text without words is linked with nothing, not even its copies.

    A row is kept if its component is named by its doc_id; rows without doc_id are, if no row of their component has one.
    """
    named = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    found = components(docs, width).select("doc_id", "n_shingles", named.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def with_copy(docs: DataFrame, name: str) -> DataFrame:
    """The documents with their copy in a column of that name."""
    schema = docs.select("*", F.lit(None).cast("long").alias(name)).schema

    def run(batches: Batches):
        for batch in batches:
            found = [copy_of(x.lower().split()) for x in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], schema.names)

    return docs.mapInArrow(run, schema)
