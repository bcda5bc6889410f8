"""Near copies against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest

from stratamart.llm import bottom_k, simhash
from tests.llm.conftest import SCHEMA


def brute_similarity(a, b, width):
    def cut(text):
        words = text.lower().split()
        return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()

    a, b = cut(a), cut(b)
    return len(a & b) / len(a | b) if a | b else float(width == 5)


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = []
    for size in (30, 120, 248, 600):
        for _ in range(4):
            text = " ".join(f"w{rng.randrange(900)}" for _ in range(size))
            out += [text, *(edited(rng, text, rng.randrange(1, max(2, size // 30))) for _ in range(6))]
            out.append(edited(rng, out[-1], max(1, size // 60)))  # in reach of one copy only
    return out + ["a b c", "A  b C", "a b d", "", " "]


def brute_least(texts, width=5):
    root = list(range(len(texts)))
    for i, j in combinations(range(len(texts)), 2):
        if brute_similarity(texts[i], texts[j], width) >= 0.8:
            a, b = sorted((root[i], root[j]))
            root = [a if x == b else x for x in root]
    return root


def test_near_copies(spark, docs, texts):
    found = {r.doc_id: r.component_id for r in bottom_k.components(_frame(spark, texts), 5).collect()}
    expected = brute_least(texts)
    assert found == dict(enumerate(expected))
    fingers = [simhash.fingerprint(x.encode()) for x in texts]
    far = [i for i, j in enumerate(expected) if i != j and all((fingers[i] ^ fingers[k]).bit_count() > 2 for k in range(len(texts)) if k != i)]
    assert len(far) > 20, "fingerprints leave these apart"
    assert {r.doc_id for r in simhash.kept(_frame(spark, texts)).collect()} == set(expected)


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s1", len(t), "", "", None) for i, t in enumerate(texts)], SCHEMA)


def test_two_words(spark, docs, texts):
    found = {r.doc_id: r for r in bottom_k.near_duplicates(_frame(spark, texts)).collect()}
    expected = brute_least(texts, 2)
    assert {i: r.component_id for i, r in found.items()} == dict(enumerate(expected))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())
    assert [found[len(texts) - i].n_shingles for i in (5, 3, 2, 1)] == [2, 2, 0, 0]
    assert found[len(texts) - 1].component_id == len(texts) - 1 and found[len(texts) - 2].component_id == len(texts) - 2


def test_fingerprint_trees_come_first(spark, docs, texts, monkeypatch):
    """The pipeline's stage takes pairs from the trees of fingerprints, verifies them, and leaves only the others to the lists."""
    import corpus_pipeline

    asked, judged = [], []
    links, judge = simhash.links, bottom_k._Judge.links
    monkeypatch.setattr(simhash, "links", lambda *a: asked.append(1) or links(*a))
    monkeypatch.setattr(bottom_k._Judge, "links", lambda self, pairs: judged.append(judge(self, pairs)) or judged[-1])
    frame = _frame(spark, texts)
    found = corpus_pipeline.near_duplicate_stage(spark, frame, "")
    assert {r.doc_id for r in found.collect()} == set(brute_least(texts))
    near = {frozenset((r.a, r.b)) for r in simhash.near_pairs(frame).collect()}
    first = {frozenset((r.a, r.b)) for r in judged[0].collect()}
    assert asked and first and first <= near
    assert all(first.isdisjoint({frozenset((r.a, r.b)) for r in x.collect()}) for x in judged[1:])


def test_all_pairs_of_a_group_of_fingerprints(spark, docs, monkeypatch):
    """Texts with one word repeated very often have one fingerprint; of these the linked ones are found without the lists' help."""
    rng, shared = random.Random(9), bottom_k._shared
    monkeypatch.setattr(bottom_k, "_shared", lambda first: shared(first).where("false"))

    def text(rest):
        return "la " * 300 + rest

    rests = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(50)) for _ in range(9)]
    texts = sorted(map(text, rests), key=lambda x: bottom_k.copy_of(x.lower().encode().split()))
    texts += [edited(rng, x, 1) for x in texts[3:] for _ in range(2)]
    assert len({simhash.fingerprint(x.encode()) for x in texts}) == 1
    expected = brute_least(texts)
    assert len(set(expected)) < len(texts)
    assert {r.doc_id for r in simhash.kept(_frame(spark, texts)).collect()} == set(expected)


def test_long_lists(spark, docs, monkeypatch):
    """A large group of edits of one text, of which many are linked to few others or to none, and a passage that all other texts hold."""
    monkeypatch.setattr(bottom_k, "SMALL", 1)
    rng = random.Random(8)
    text, passage = (" ".join(f"v{rng.randrange(900)}" for _ in range(n)) for n in (100, 40))
    texts = [edited(rng, text, rng.randrange(1, 12)) for _ in range(90)]
    for _ in range(20):
        texts.append(passage + " " + " ".join(f"v{rng.randrange(900)}" for _ in range(30)))
        texts.append(edited(rng, texts[-1], 2))
    for width in (2, 5):
        found = {r.doc_id: r.component_id for r in bottom_k.components(_frame(spark, texts), width).collect()}
        assert found == dict(enumerate(brute_least(texts, width)))


def test_sketches(spark):
    """The sketch is the bottom of the set, and retained values of linked sets always have one in common."""
    rng = random.Random(4)
    classes = np.array([rng.randrange(9) for _ in range(bottom_k.COUNTERS)], np.uint8)
    for _ in range(200):
        n = rng.randrange(1, 700)
        a = np.array(sorted(rng.getrandbits(64) for _ in range(n)), np.uint64)
        b = np.unique(np.concatenate([np.delete(a, rng.sample(range(n), rng.randrange(0, n // 6 + 1))), np.array([rng.getrandbits(64) for _ in range(rng.randrange(0, n // 8 + 1))], np.uint64)]))
        if bottom_k.linked(a, b):
            assert set(bottom_k.retained(a, classes)) & set(bottom_k.retained(b, classes))
            assert bottom_k.likely(bottom_k.sketch(a), bottom_k.sketch(b))
        assert len(bottom_k.sketch(a)) == min(n, bottom_k.SKETCH)
    far = [np.array(sorted(rng.getrandbits(64) for _ in range(300)), np.uint64) for _ in range(2)]
    assert not bottom_k.likely(*map(bottom_k.sketch, far))


def test_texts_that_share_a_little_by_chance_never_leave_their_lists(spark, docs, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(25)}" for _ in range(60)) for _ in range(300)]
    texts += [edited(rng, x, 1) for x in texts[:20]]
    asked, held = [], bottom_k._held
    monkeypatch.setattr(bottom_k, "_held", lambda pairs, *a: asked.append(pairs.count()) or held(pairs, *a))
    found = {r.doc_id: r.component_id for r in bottom_k.components(_frame(spark, texts), 2).collect()}
    assert found == dict(enumerate(brute_least(texts, 2))) and len(set(found.values())) == 300
    assert max(asked) < 100, "candidates don't grow with the pairs of a list"


def test_marks():
    """A tenth of the marks differ at a similarity of 0.8, in small sets too; nearly half where little is shared."""
    rng = random.Random(6)
    for union in (5, 10, 45, 900):
        values = np.array([[rng.getrandbits(64) for _ in range(union)] for _ in range(200)], np.uint64)
        apart = [sum((int(x) & (1 << 64) - 1).bit_count() for x in bottom_k.marks(row[: union * 9 // 10]) ^ bottom_k.marks(row[union // 10 :])) for row in values]
        assert max(apart) <= bottom_k.MARKS_APART
    far = [bottom_k.marks(np.array([rng.getrandbits(64) for _ in range(5_000)], np.uint64)) for _ in range(2)]
    assert sum((int(x) & (1 << 64) - 1).bit_count() for x in far[0] ^ far[1]) > bottom_k.MARKS_APART


def test_no_documents_and_awkward_ones(spark, docs, no_docs, nameless, rows):
    assert bottom_k.near_duplicates(no_docs).collect() == []
    found = bottom_k.near_duplicates(docs).collect()
    assert len(found) == len(rows) and all(r.n_shingles == 0 and r.kept for r in found if r.doc_id == 500)
    ids = {r.doc_id: (r.component_id, r.kept) for r in bottom_k.near_duplicates(nameless.where("text not like 'alone%'")).collect()}
    assert ids == {None: (7, False), 7: (7, True)}


def test_columns_with_clashing_names(spark, docs):
    frame = _frame(spark, ["a b c", "A b  c", "x"]).withColumnRenamed("n_words", "copy").withColumnRenamed("simhash", "first_id")
    found = simhash.kept(frame)
    assert found.columns == frame.columns and sorted(r.doc_id for r in found.collect()) == [0, 2]


def test_repeated_ids_with_other_texts(spark, docs):
    rng = random.Random(2)
    a, b, c, d, e = (" ".join(f"u{rng.randrange(900)}" for _ in range(60)) for _ in range(5))
    rows = [(1, a), (2, edited(rng, a, 1)), (2, b), (2, b), (3, b), (4, c), (4, edited(rng, c, 1)), (5, d), (5, e)]
    found = simhash.kept(spark.createDataFrame([(i, t, "en", "s1", len(t), "", "", None) for i, t in rows], SCHEMA)).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 4, 5, 5], "no text of a group of its own is lost"
    assert {(1, a), (2, b)} <= {(r.doc_id, r.text) for r in found}
