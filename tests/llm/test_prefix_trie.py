"""The conversation trie against one that is built node by node."""

import hashlib
import random
import zlib

import pytest

from stratamart.llm import prefix_trie
from stratamart.llm.common import importable

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, n_convs string"


def conversations(rng, n, long_one=0):
    """Some share beginnings, some are equal, some have gaps in their ids, nulls or equal turns."""
    openings = [[("user", f"q{i}" * (i + 1)), ("bot", "é" * i)] * (i + 1) for i in range(4)]
    out = {}
    for c in range(-7, n):
        if c % 7 == 3:
            continue
        own = [(rng.choice(["user", None]), rng.choice(["a", "", None, "日本", "ab"])) for _ in range(rng.randrange(1, 6))]
        out[c] = (rng.choice(openings) if rng.random() < 0.7 else []) + (own if rng.random() < 0.8 else own[:1])
    out[1000] = [("user", str(i % 3)) for i in range(long_one)]
    out[1001] = list(out[1000])
    rows = [(c, None if i == 0 and c % 2 else i, role, text, "x", "y", "z") for c, turns in out.items() for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def brute(rows):
    found = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()
            found.setdefault(c, []).append((turn is not None, turn or 0, digest, role or "", text or ""))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in found.items()}

    def first(c):
        return c - (abs(c) % 5) * (1 if c >= 0 else -1)

    rebuilt = {c: tuple(own.get(first(c), [])[: (h := zlib.crc32(str(c).encode()) % 9)] + turns[h:]) for c, turns in own.items()}
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    below = {node: [x for x in members if x[: len(node)] == node] for node in members}
    childless = {x for x in members if len(below[x]) == 1}
    saved = {x: (len(m) - 1) * len(x[-1][1].encode()) if x else 0 for x, m in members.items()}
    out = []
    for node, m in members.items():
        children = [x for x in below[node] if len(x) == len(node) + 1]
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        leaves, kept = sum(x in childless for x in below[node]), sum(saved[x] for x in below[node])
        out.append((min(m), len(node), parent, len(m), len(children), leaves, kept, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, n, long_one", [(1, 60, 30), (2, 25, 17), (3, 90, 8)])
def test_equals_a_trie_built_node_by_node(spark, seed, n, long_one):
    importable(spark)
    rows = conversations(random.Random(seed), n, long_one)
    rows += [rows[0], rows[1], (None, 1, "user", "nobody's", "", "", "")]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_only_empty_conversations(spark):
    """A conversation whose first turns come from an absent one may be left without any."""
    importable(spark)
    ids = [c for c in range(1, 60) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1]
    rows = [(c, 0, "user", "x", "", "", "") for c in ids]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows) and len(found) == 1


def test_no_conversations(spark):
    importable(spark)
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ends_over_many_ranges(spark):
    """Equal conversations whose ids lie in several ranges end in one node, in numeric order."""
    importable(spark)
    rows = [(c * 505, 0, "user", "x", "", "", "") for c in range(40)]
    assert 40 * 505 > 5 * prefix_trie.SPAN
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_lone_blocks_are_not_grouped_by_turn(spark):
    importable(spark)
    rows = [(c * 5, i, "user", f"{i}", "", "", "") for c in range(3) for i in range(prefix_trie.BLOCK)]
    rows += [(c * 5, prefix_trie.BLOCK + 1, "user", f"own {c}", "", "", "") for c in range(3)]
    blocks = prefix_trie._distinct_blocks(prefix_trie.steps(spark.createDataFrame(rows, SCHEMA)))
    assert sorted((r["start"], r["alone"], r["n_convs"]) for r in blocks.collect()) == [(0, True, 3)] + [(prefix_trie.BLOCK, False, 1)] * 3
