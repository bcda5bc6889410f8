"""Near-duplicates by SimHash, with BK-trees over shards of the fingerprints.

A fingerprint of 64 bits is cut into four blocks. Fingerprints at most two bits apart agree on at
least two blocks, so every pair of blocks makes a shard of those that agree on it, and every link
lies within a shard. A shard is a BK-tree: children are keyed by their Hamming distance to the
parent, and a search follows only keys within the radius of its own distance. Shards are dealt by
shuffle, as all trees together grow with the documents and so can't be broadcast.

Only which fingerprints belong together is asked for, so a search also leaves out a subtree that is
known to lie wholly in its own component, and a tree gives one link for each member to its local
root, never all pairs. Copies are one fingerprint before any shard is built.

Defined cases: null and empty texts have fingerprint zero, which is linked like any other; repeated
rows each give a row; rows without doc_id belong to components but never name one, and a component
of such rows alone has a null component_id; other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm import bottom_k
from stratamart.llm.common import Batches, partitions, text_bytes, unused, written
from stratamart.llm.components import roots

RADIUS = 2
SHINGLE = 3
SEED = 42
_BLOCKS, _BLOCK_BITS = 4, 16
_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """Bits that are set in over half of the hashes of the three-word shingles."""
    words = text.lower().split()  # lowers A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: -SHINGLE] + 1).tolist()]
    spans = zip(starts, ends[SHINGLE - 1 :].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        part = hashes[at : at + _AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint as a signed number."""

    def run(batches: Batches):
        for batch in batches:
            found = np.array([fingerprint(x) for x in text_bytes(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found)], ["doc_id", "simhash"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, simhash long")


class Tree:
    """A BK-tree that gathers the components of its members."""

    def __init__(self, radius: int = RADIUS):
        self.radius, self.top, self.parent = radius, None, {}

    def root(self, x: int) -> int:
        while (up := self.parent[x]) != x:
            self.parent[x] = x = self.parent[up]
        return x

    def add(self, x: int) -> None:
        """Link x to the members within the radius, then insert it."""
        self.parent[x] = x
        stack, radius = [self.top] if self.top else [], self.radius
        while stack:
            value, children, whole = stack.pop()
            if whole[0] and self.root(value) == self.root(x):
                continue  # every member below is already in the component of x
            away = (value ^ x).bit_count()
            if away <= radius:
                self.parent[self.root(x)] = self.root(value)
            stack += [children[d] for d in range(max(1, away - radius), away + radius + 1) if d in children]
        new = (x, {}, [True])
        at = self.top
        if at is None:
            self.top = new
        while at:
            value, children, whole = at
            whole[0] = whole[0] and self.root(value) == self.root(x)
            at = children.get(away := (value ^ x).bit_count())
            if at is None:
                children[away] = new

    def links(self) -> Iterator[tuple[int, int]]:
        return ((x, root) for x in self.parent if (root := self.root(x)) != x)


def shards(simhashes: DataFrame) -> DataFrame:
    """One row for each fingerprint and pair of blocks; `shard` is the pair and its bits."""

    def block(i: int):
        return F.shiftrightunsigned("simhash", _BLOCK_BITS * i).bitwiseAND((1 << _BLOCK_BITS) - 1)

    keys = [
        F.shiftleft(F.lit(n).cast("long"), 2 * _BLOCK_BITS).bitwiseOR(F.shiftleft(block(i), _BLOCK_BITS)).bitwiseOR(block(j))
        for n, (i, j) in enumerate(combinations(range(_BLOCKS), 2))
    ]
    return simhashes.select(F.explode(F.array(*keys)).alias("shard"), "simhash")


def links(simhashes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints of one component."""

    def run(batches: Batches):
        tree, shard = Tree(radius), None
        for batch in batches:
            found: list[tuple[int, int]] = []
            values = batch.column("simhash").to_numpy().view(np.uint64).tolist()
            for key, value in zip(batch.column("shard").to_pylist(), values, strict=True):
                if key != shard:
                    found += tree.links()
                    tree, shard = Tree(radius), key
                tree.add(value)
            yield _pairs(found)
        yield _pairs(list(tree.links()))

    dealt = shards(simhashes).repartition(partitions(simhashes.sparkSession), "shard").sortWithinPartitions("shard", "simhash")
    return dealt.mapInArrow(run, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], ["a", "b"])


def components(docs: DataFrame) -> DataFrame:
    """doc_id, the fingerprint as a number, and component_id, the least doc_id that can be reached over links."""
    own = written(fingerprints(docs), "simhash")
    firsts = written(own.groupBy("simhash").agg(F.min("doc_id").alias("first_id")), "simhash-first")
    linked = written(roots(links(firsts.select("simhash"))), "simhash-roots")
    members = linked.union(linked.select("root", "root").distinct()).join(firsts, F.col("node") == F.col("simhash"))
    least = members.groupBy("root").agg(F.min("first_id").alias("least_id"))
    named = members.join(least, "root").select("simhash", "least_id")
    names = firsts.join(named, "simhash", "left").select("simhash", F.coalesce("least_id", "first_id").alias("component_id"))
    return own.join(names, "simhash").select("doc_id", "simhash", "component_id")


def component_ids(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal digits, component_id."""
    return components(docs).select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def near_pairs(docs: DataFrame) -> DataFrame:
    """Copies with words that are in one component of fingerprints, as pairs (a, b) of the least copy and each other one.

    They name the whole group: bottom_k verifies these pairs first and then holds the members that are still apart against each other.
    """

    def run(batches: Batches):
        for batch in batches:
            texts = [x for x in text_bytes(batch) if x.split()]
            copies = pa.array([bottom_k.copy_of(x.lower().split()) for x in texts], pa.int64())
            found = np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([copies, pa.array(found)], ["copy", "simhash"])

    own = written(docs.select("text").mapInArrow(run, "copy long, simhash long").distinct(), "simhash-copies")
    linked = written(roots(links(own.select("simhash").distinct())), "simhash-roots")
    rooted = own.join(linked, F.col("simhash") == F.col("node"), "left").select("copy", F.coalesce("root", "simhash").alias("root"))
    least = rooted.groupBy("root").agg(F.min("copy").alias("a"))
    return written(rooted.join(least, "root").where("a <> copy").select("a", F.col("copy").alias("b")), "simhash-pairs")


def kept(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies, that with the least doc_id, with all its columns.

    Two texts are near copies if their five-word shingles have a similarity of 0.8. The trees of fingerprints give the first
    groups: each member is held against the least one on the full sets, then those still apart against each other. As few
    texts of that similarity are within two bits, the lists of bottom_k give the pairs between groups. Texts without words are one group. Of texts of
    a group that share this doc_id the one of the least copy stays, and one of its rows; rows without doc_id stay if no row of their group has one.
    """
    found = bottom_k.components(docs, 5, near_pairs(docs))
    copy, first_id, first_copy = unused(docs, "copy", "first_id", "first_copy")
    first = found.where("doc_id = component_id").groupBy("root").agg(F.first("doc_id").alias(first_id), F.min("copy").alias(first_copy))
    here = (F.col("doc_id") == F.col(first_id)) & (F.col(copy) == F.col(first_copy))
    named = bottom_k.with_copy(docs, copy).join(first.drop("root"), here).dropDuplicates(["doc_id", copy]).select(*docs.columns)
    nameless = docs.where("doc_id is null")
    if not nameless.take(1):
        return named
    alone = found.where("component_id is null").select(F.col("copy").alias(first_copy)).distinct()
    return named.unionByName(bottom_k.with_copy(nameless, copy).join(alone, F.col(copy) == F.col(first_copy), "left_semi").drop(copy))
