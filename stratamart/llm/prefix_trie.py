"""Prefix trie of conversations by fixed-length block hashing.

Every conversation becomes a chain of 128-bit digests, one for each turn, each over the digest before
it and the turn, so equal digests mean equal beginnings. Conversations are grouped by whole blocks of
BLOCK turns first: a block is named by the digest at its end, and equal blocks are one row with a
count. A block without siblings is a path without forks, so its turns have its members; only where
a parent has several child blocks are their turns unfolded and grouped one by one.

What a node says of its subtree comes without walking it. The least member of a node is also the least
of every node below that it reaches, so each conversation owns the end of its own path, from some
turn on. Leaves are counted with their owners. What the members of a node share is, for each member but the
least, the bytes of the turns that it doesn't own, less those above the node. Both are sums over members,
aggregated by the same blocks in a second pass.

Each conversation's turns pass through one task as rows of some 50 bytes, sorted and streamed; its texts
are hashed where they are read. Conversations that end at a node are gathered in ranges of SPAN ids
each and only their digest passes over all of them, one range at a time.

Defined cases: null is first among turns; a null role or text is empty; rows of one conversation with equal
turns are ordered by their digest, so repeated rows are turns of their own; rows without conv_id belong to
no conversation; without conversations there are no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Batches, partitions, written

BLOCK = 8
#: A conversation takes its first turns from the first of each FAMILY of ids, HEADS - 1 at most.
FAMILY, HEADS = 5, 9
SPAN = 1024
_ROOT = bytes(16)
_STEPS = "conv_id long, start int, parent binary, key binary, turns array<struct<parent: binary, key: binary, before: bigint>>, total long"
_KINDS = {
    "conv_id": pa.int64(),
    "start": pa.int32(),
    "parent": pa.binary(),
    "key": pa.binary(),
    "turns": pa.list_(pa.struct([("parent", pa.binary()), ("key", pa.binary()), ("before", pa.int64())])),
    "total": pa.int64(),
}


def own_turns(conversations: DataFrame) -> DataFrame:
    """The turns as they stand: conv_id, turn, digest and n_bytes of the text."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def family(conv_id: Column) -> Column:
    return conv_id - conv_id % FAMILY


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


class _Path:
    """One conversation's chain of digests, cut into blocks."""

    def __init__(self, conv_id: int):
        self.conv_id, self.depth, self.key, self.total = conv_id, 0, _ROOT, 0
        self.start, self.parent, self.turns = 0, _ROOT, []

    def add(self, digest: bytes, n_bytes: int) -> list[tuple]:
        """The block that was full before this turn, if one was."""
        done = [self.block()] if len(self.turns) == BLOCK else []
        above, self.key = self.key, hashlib.blake2b(self.key + digest, digest_size=16).digest()
        self.turns.append({"parent": above, "key": self.key, "before": self.total})
        self.depth, self.total = self.depth + 1, self.total + n_bytes
        return done

    def block(self, last: bool = False) -> tuple:
        row = (self.conv_id, self.start, self.parent, self.key, self.turns, self.total if last else None)
        self.start, self.parent, self.turns = self.depth, self.key, []
        return row


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _KINDS.values(), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in columns], list(_KINDS))


def _chained(batches: Batches):
    """Blocks of the rebuilt conversations, from turns sorted by family, then its first conversation, then the others."""
    head_of, head, path, seen = None, [], None, 0
    for batch in batches:
        rows = []
        for of, conv_id, take, digest, n_bytes in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if path is None or conv_id != path.conv_id:
                if path:
                    rows.append(path.block(last=True))
                if of != head_of:
                    head_of, head = of, []
                path, seen = _Path(conv_id), 0
                for turn in head[:take] if conv_id != of else []:
                    rows += path.add(*turn)
            seen += 1
            if conv_id == of and seen < HEADS:
                head.append((digest, n_bytes))
            if conv_id == of or seen > take:
                rows += path.add(digest, n_bytes)
        if rows:
            yield _blocks(rows)
    if path:
        yield _blocks([path.block(last=True)])


def steps(conversations: DataFrame) -> DataFrame:
    """A row for each block of each rebuilt conversation; the last one has its bytes in `total`."""
    conv_id = F.col("conv_id")
    dealt = own_turns(conversations).select(family(conv_id).alias("of"), conv_id, heads(conv_id).cast("int").alias("take"), "digest", "n_bytes", "turn")
    dealt = dealt.repartition(partitions(conversations.sparkSession), "of")
    dealt = dealt.sortWithinPartitions("of", F.col("conv_id") != F.col("of"), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return dealt.mapInArrow(_chained, _STEPS)


def _distinct_blocks(found: DataFrame) -> DataFrame:
    """Each block once, with its members counted, its least member, and whether it has no sibling."""
    equal = found.where("size(turns) > 0").groupBy("key").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *(F.first(x).alias(x) for x in ("parent", "start", "turns"))
    )
    blocks = written(equal, "trie-equal")
    alone = blocks.groupBy("parent").agg(F.count("*").alias("siblings")).where("siblings = 1").select("parent", F.lit(True).alias("alone"))
    return blocks.join(alone, "parent", "left").select("key", "start", "turns", "n_convs", "conv_id", F.coalesce("alone", F.lit(False)).alias("alone"))


def _unfolded(blocks: DataFrame, *measures: Column) -> DataFrame:
    """A row for each turn: of a block alone as it stands, of siblings grouped by the turn's digest."""
    others = [c for c in blocks.columns if c not in ("alone", "start", "turns", "key")]
    wide = blocks.select("*", F.posexplode("turns").alias("place", "at")).select(
        "alone", (F.col("start") + F.col("place") + 1).alias("depth"), *(F.col(f"at.{x}").alias(f"at_{x}") for x in ("parent", "key", "before")), *others
    )
    keep = [F.first(x).alias(x) for x in ("depth", "at_parent", "at_before")]
    forked = wide.where("not alone").groupBy("at_key").agg(*keep, *measures)
    lone = wide.where("alone").select(*forked.columns)
    return forked.unionByName(lone)


def _ends(found: DataFrame) -> DataFrame:
    """For each node at which conversations end, the digest of their ids in ascending order."""

    def run(batches: Batches):
        last, digest = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

        for batch in batches:
            done = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last is not None:
                    done.append((last, digest.hexdigest()))
                last, digest = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], ["key", "ends_sha256"])
        if last is not None:
            yield row()

    last = found.where("total is not null").select("key", "conv_id", F.floor(F.col("conv_id") / SPAN).alias("span"))
    # at most SPAN ids in a row, as each conversation ends once
    ranges = last.groupBy("key", "span").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    dealt = ranges.repartition(partitions(found.sparkSession), "key").sortWithinPartitions("key", "span").select("key", "ids")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    found = written(steps(conversations), "trie-steps")
    blocks = written(_distinct_blocks(found), "trie-blocks")
    top = found.where("total is not null").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("conv_id is not null")
    top = top.select(F.lit(_ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).alias("depth"), "n_convs", "conv_id", F.lit(0).cast("long").alias("before"))
    turns = _unfolded(blocks, F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    turns = turns.select(F.col("at_key").alias("key"), F.col("at_parent").alias("parent"), "depth", "n_convs", "conv_id", F.col("at_before").alias("before"))
    bare = written(turns.unionByName(top), "trie-turns")
    children = bare.where("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "key")
    nodes = written(bare.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-nodes")

    # what each conversation shares with a lesser one, and whether it owns a leaf
    owned = nodes.groupBy("conv_id").agg(F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    members = found.where("total is not null").select("conv_id", "total").join(owned, "conv_id", "left")
    members = written(members.select("conv_id", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "trie-members")
    sums = [F.sum("shared").alias("shared"), F.sum("leaf").alias("leaves")]
    by_block = found.where("size(turns) > 0").select("key", "conv_id").join(members, "conv_id").groupBy("key").agg(*sums)
    weighed = blocks.select("key", "start", "turns", "alone").join(by_block, "key")
    below = _unfolded(weighed, F.sum("shared").alias("shared"), F.sum("leaves").alias("leaves")).select(F.col("at_key").alias("key"), "shared", "leaves")
    below = below.unionByName(members.agg(*sums).select(F.lit(_ROOT).alias("key"), "shared", "leaves"))

    own = members.select("conv_id", F.col("shared").alias("own_shared"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    full = nodes.join(below, "key").join(own, "conv_id").join(_ends(found), "key", "left").join(above, "parent", "left")
    return full.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        (F.col("shared") - F.col("own_shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
