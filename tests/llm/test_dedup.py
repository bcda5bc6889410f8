"""Substring, line and near-duplicate removal and fingerprints against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from stratamart.llm import fingerprints, line_dedup, simhash, substring_dedup
from stratamart.llm.components import roots


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def removed_words(rows):
    """By definition, for rows with unique ids or equal repeated rows."""
    first = {}
    for doc_id, text in rows:
        words = split_words(text)
        for i in range(len(words) - 12):
            key = tuple(words[i : i + 13])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = split_words(text)
        gone = [False] * len(words)
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < doc_id:
                gone[i : i + 13] = [True] * 13
        out.append((doc_id, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return sorted(out)


def test_substring_dedup(docs, rows):
    found = substring_dedup.deduplicated(docs, with_text=True).collect()
    expected = removed_words([(r[0], r[1] or "") for r in rows])
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == expected
    assert sum(e[2] for e in expected) > 100
    assert all(sha(r.kept) == r.kept_sha256 for r in found if r.kept is not None)


@pytest.mark.parametrize("seed", range(2))
def test_substring_dedup_with_branching_repeats(spark, docs, seed):
    rng = random.Random(seed)
    parts = [" ".join(f"p{n}x{rng.randrange(9)}" for _ in range(rng.randrange(5, 25))) for n in range(6)]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(6)))) for i in rng.sample(range(100), 30)]
    found = substring_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, found.collect())) == removed_words(rows)


def test_substring_dedup_edge_cases(no_docs, nameless, spark):
    assert substring_dedup.deduplicated(no_docs).collect() == []
    assert {(r.doc_id, r.n_removed) for r in substring_dedup.deduplicated(nameless).collect()} == {(None, 0), (7, 0)}
    text = " ".join(f"w{i}" for i in range(20))
    same_id = spark.createDataFrame([(5, text + " a"), (5, text + " b"), (6, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup.deduplicated(same_id).collect()) == [(5, 0), (5, 0), (6, 20)]


def test_line_dedup(spark, docs, no_docs, rows):
    sites = {}
    plain = lambda x: x.strip(" \t\r\x0b\x0c")
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if plain(line) and r[3]:
                sites.setdefault(plain(line), set()).add(r[3])
    common = {line for line, own in sites.items() if len(own) >= line_dedup.MIN_SITES}
    assert common
    expected = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if plain(x) not in common]
        expected.append((r[0], sum(bool(plain(x)) for x in lines), len(lines) - len(kept), sha("\n".join(kept))))
    assert sorted(map(tuple, line_dedup.line_counts(docs).collect())) == sorted(expected)
    cleaned = line_dedup.cleaned(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    assert {(r.doc_id, sha(r.text)) for r in cleaned.collect() if r.text is not None} == {(e[0], e[3]) for e in expected if e[0] != 500}
    assert cleaned.where("doc_id = 500").first().text is None
    assert line_dedup.cleaned(no_docs).collect() == []
    plan = line_dedup.cleaned(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [8, 9, 10, 11, 40, 300])
def test_sites_near_the_threshold_are_counted_exactly(spark, n):
    rows = [(i, "the line\nmine", f"s{i % n}", None) for i in range(2 * n)]
    found = line_dedup.boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"), 10).count()
    assert found == (2 if n >= 10 else 0)


def brute_fingerprint(text):
    words = split_words(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius=2):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_simhash(docs, no_docs, rows):
    prints = {r[0]: brute_fingerprint(r[1] or "") for r in rows}
    root = groups(set(prints.values()))
    least = {}
    for doc_id, value in prints.items():
        least[root[value]] = min(least.get(root[value], doc_id), doc_id)
    found = simhash.component_ids(docs).collect()
    assert sorted(map(tuple, found)) == sorted((r[0], f"{prints[r[0]]:016x}", least[root[prints[r[0]]]]) for r in rows)
    kept = simhash.kept(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert simhash.component_ids(no_docs).collect() == [] and simhash.kept(no_docs).collect() == []


def test_simhash_without_ids(nameless):
    found = sorted(((r.doc_id, r.component_id) for r in simhash.component_ids(nameless).collect()), key=str)
    assert found == [(7, 7), (None, 7), (None, None)]
    assert sorted(map(str, (r.doc_id for r in simhash.kept(nameless).collect()))) == ["7", "None"]


@pytest.mark.parametrize("seed", range(10))
def test_trees_lose_no_link(seed):
    rng = random.Random(seed)
    centre, values = rng.getrandbits(64), set()
    for _ in range(250):
        x = centre
        for bit in rng.sample(range(64), rng.randrange(9)):
            x ^= 1 << bit
        values.add(x)
    tree, values = simhash.Tree(), list(values)
    for x in values:
        tree.add(x)
    root = groups(values)
    own, expected = {}, {}
    for x in values:
        own.setdefault(tree.root(x), set()).add(x)
        expected.setdefault(root[x], set()).add(x)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))


def test_links_reach_across_shards(spark, docs):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(50)}
    for x in list(values):
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randrange(3)):
                x ^= 1 << bit
            values.add(x)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = roots(simhash.links(spark.createDataFrame(signed, "simhash long")))
    root = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in found.collect()}
    own, expected = {}, {}
    brute = groups(values)
    for v in values:
        own.setdefault(root.get(v, v), set()).add(v)
        expected.setdefault(brute[v], set()).add(v)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(100, 101), (7, 7), (300, 200)]
    found = {(r.node, r.root) for r in roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 30)} | {(300, 200)}
    assert roots(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprints(docs, rows, no_docs):
    found = fingerprints.fingerprints(docs).collect()
    unique = sorted({r[0]: r[1] or "" for r in rows}.items())
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    repeated = rows[0][0]
    for i, (doc_id, text) in enumerate(unique):
        following = unique[(i + 1) % len(unique)][1]
        cut = len(text) // 4
        own = by_id[doc_id]
        assert own.n_chars == len(text) and 0 <= own.near_next <= 1
        if doc_id != repeated:
            assert own.edited_sha256 == sha(text[: len(text) - cut] + following[:cut])
    same = {}
    for doc_id, text in unique:
        same.setdefault(text, set()).add(by_id[doc_id].fingerprint)
    assert all(len(x) == 1 for x in same.values()) and len({x for v in same.values() for x in v}) == len(same)
    long = [by_id[d] for d, t in unique if len(split_words(t)) > 40 and d != repeated]
    assert sum(r.near_edited for r in long) > 5 * sum(r.near_next for r in long)
    assert fingerprints.fingerprints(no_docs).collect() == []
    plan = fingerprints.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fingerprints_of_one_document_and_without_ids(spark, docs):
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "alpha beta gamma delta")], "doc_id long, text string")).first()
    assert one.edited_sha256 == sha("alpha beta gamma alpha"[:17] + "alpha"[:5]) and one.near_next == 1.0
    none = spark.createDataFrame([(None, "some words here"), (None, "other words"), (3, "third text")], "doc_id long, text string")
    assert fingerprints.fingerprints(none).count() == 3
