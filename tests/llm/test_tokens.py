"""Token counts, byte-level BPE and packing against the tokenizers' own libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from stratamart.llm import block_sums, byte_bpe, packing, token_counts

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def reference():
    with open(BYTES, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(own, text):
    return own.encode(text or "", add_special_tokens=False).ids


def test_token_counts(docs, rows, own):
    found = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, WORDS).collect())
    expected = [(r[0], len((r[1] or "").encode()), n := len(ids_of(own, r[1])), n > 2048) for r in rows]
    assert found == sorted(expected) and any(x[3] for x in expected)


@pytest.mark.parametrize("known", [0, 400])
def test_token_counts_with_a_shuffled_tail(docs, rows, own, monkeypatch, known):
    """Few or no pre-tokens are broadcast, and blocks are small."""
    monkeypatch.setattr(token_counts, "MOST_KNOWN", known)
    monkeypatch.setattr(block_sums, "MOST_BYTES", 3000)
    found = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(docs, WORDS).collect())
    expected = [(r[0], len((r[1] or "").encode()), n := len(ids_of(own, r[1])), n > 2048) for r in rows]
    assert found == sorted(expected)


def test_token_counts_without_documents_or_ids(no_docs, nameless):
    assert token_counts.token_counts(no_docs, WORDS).collect() == []
    assert sorted(str(r.doc_id) for r in token_counts.token_counts(nameless, WORDS).collect()) == ["7", "None", "None"]


def test_matches_outside_the_vocabulary_go_through_joins(reference):
    rng = random.Random(9)
    bpe = byte_bpe.TreeBpe(byte_bpe.vocabulary(BYTES, public_tokenizers.PATTERN).ranks, public_tokenizers.PATTERN)
    matches = {(" " + "".join(rng.choice("aeiourstnlé") for _ in range(rng.randrange(1, 30)))).encode() for _ in range(1500)}
    outside = [m for m in matches if m not in bpe.ranks and len(m) > byte_bpe.LEAF_BYTES]
    for match in outside:
        before = bpe.joins
        assert [bpe.ranks[t] for t in bpe.tree(match)] == reference.encode_ordinary(match.decode())
        assert bpe.joins > before
    assert len(outside) > 500


def test_added_tokens_inside_texts(own):
    texts = ["a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> <|endoftext|>.", "x\x1cy it's 12 IT'LL é"]
    known, none = token_counts.pieces(WORDS), token_counts.Known(*(np.zeros(0, x) for x in (np.uint64, np.uint32, np.int32)))
    names, packed, occurrences, n_known = token_counts.block_frequencies([t.encode() for t in texts], known, none)
    totals = np.zeros(len(texts), int)
    for name, entries in zip(names, packed.to_pylist(), strict=True):
        for place, n in np.frombuffer(entries, block_sums.ENTRY):
            totals[place] += n * known.count(name.decode())
        assert occurrences[names.index(name)] == np.frombuffer(entries, block_sums.ENTRY)["count"].sum()
    assert totals.tolist() == [len(ids_of(own, t)) for t in texts] and not n_known.any()
    low, high = token_counts.hashes(names)
    table = token_counts.Known(low[::2], high[::2], np.array([known.count(x.decode()) for x in names[::2]], np.int32))
    rest, packed, _, n_known = token_counts.block_frequencies([t.encode() for t in texts], known, table)
    assert rest == names[1::2] and table.of(names)[1::2].max() == -1
    for name, entries in zip(rest, packed.to_pylist(), strict=True):
        for place, n in np.frombuffer(entries, block_sums.ENTRY):
            n_known[place] += n * known.count(name.decode())
    assert n_known.tolist() == totals.tolist()
    packed_ids = packing._word_ids(WORDS)
    for text in texts:
        assert np.frombuffer(b"".join(packed_ids[w] for w in text.encode().split()), "<u4").tolist() == ids_of(own, text)


@pytest.mark.parametrize("seed", range(3))
def test_stems_and_punctuation(own, seed):
    rng, known = random.Random(seed), packing._word_ids(WORDS)
    signs = [*"aBé.,'sS1!?*#", "'s", "É", "́", "<|endoftext|>", "<|", "|>", "\x1c", "\xa0", "ß", "İ", "Σ", " "]
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(12)))
        assert np.frombuffer(b"".join(known[w] for w in text.encode().split()), "<u4").tolist() == ids_of(own, text)


def test_round_trips(docs, rows, reference):
    found = byte_bpe.round_trips(docs, BYTES, public_tokenizers.PATTERN).collect()
    expected = []
    for r in rows:
        ids = reference.encode_ordinary(r[1] or "")
        expected.append((r[0], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted(map(tuple, found)) == sorted(expected)


def test_encode_and_decode(docs, no_docs, rows, reference):
    ids = byte_bpe.encoded(docs, BYTES, public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.ids) for r in ids.collect()) == sorted((r[0], reference.encode_ordinary(r[1] or "")) for r in rows)
    back = byte_bpe.decoded(ids, BYTES, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.data)) for r in back) == sorted((r[0], (r[1] or "").encode()) for r in rows)
    assert byte_bpe.round_trips(no_docs, BYTES, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_tree_equals_the_library(reference, seed):
    rng, bpe = random.Random(seed), byte_bpe.vocabulary(BYTES, public_tokenizers.PATTERN)
    signs = ["a", "the", "é", " ", "  ", "\n", "'s", "12", "!!", "\x1c", "\x85", "　", "日", "👍", "tion", "<|endoftext|>", "​"]
    known = byte_bpe.Stretches(bpe)
    for _ in range(1500):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(25)))
        ids = [int(x) for part in known.of(text) for x in part[0].split()]
        assert ids == bpe.encode(text) == reference.encode_ordinary(text)
    long = "".join(rng.choice("abcdeinorst") for _ in range(3000))
    assert bpe.encode(long) == reference.encode_ordinary(long)
    half = len(long) // 3
    assert bpe.join(bpe.tree(long[:half].encode()), bpe.tree(long[half:].encode())) == bpe.tree(long.encode())


def best_fit(lengths, size):
    used = []
    for n in sorted(lengths, reverse=True):
        fits = [u for u in used if u + n <= size]
        if fits:
            used.remove(max(fits))
            used.append(max(fits) + n)
        else:
            used.append(n)
    return len(used)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit(seed):
    rng, size = random.Random(seed), random.Random(seed).choice([10, 64, 300])
    counts = {rng.randint(1, size): rng.randint(1, 40) for _ in range(30)}
    plan = packing.planned(counts, size)
    slots, ranks = {}, {}
    for length, first, last, per, sequence, base in plan:
        for r in range(first, last):
            slots.setdefault(sequence + (r - first) // per, []).append((base + length * ((r - first) % per), length))
            ranks.setdefault(length, []).append(r)
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
    for own in slots.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size
    assert len(slots) == best_fit([n for n, c in counts.items() for _ in range(c)], size)
    assert len(plan) <= 3 * size


def test_packing(docs, rows, own):
    found = packing.pack(docs, WORDS, with_ids=True).collect()
    expected = {}
    for r in rows:
        expected.setdefault(r[0], []).append([*ids_of(own, r[1]), 0])
    pieces, sequences = {}, {}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
        pieces.setdefault((r.doc_id, r.start), []).append(r.ids)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, texts in expected.items():
        own_pieces = sorted((start, ids) for (d, start), all_ids in pieces.items() if d == doc_id for ids in all_ids)
        assert sorted(x for _, ids in own_pieces for x in ids) == sorted(x for ids in texts for x in ids)
        assert [ids for start, ids in own_pieces if start == 0][0] == texts[0][:2048]
    for own_slots in sequences.values():
        end = 0
        for offset, length in sorted(own_slots):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) == best_fit([r.length for r in found], 2048)


def test_packing_without_documents_or_ids(no_docs, nameless):
    assert packing.pack(no_docs, WORDS).collect() == []
    assert sorted(str(r.doc_id) for r in packing.pack(nameless, WORDS).collect()) == ["7", "None", "None"]


def test_a_word_is_encoded_once_whatever_signs_follow(monkeypatch):
    bpe = byte_bpe.TreeBpe(byte_bpe.vocabulary(BYTES, public_tokenizers.PATTERN).ranks, public_tokenizers.PATTERN)
    asked, tree = [], bpe.tree
    monkeypatch.setattr(bpe, "tree", lambda data: asked.append(data) or tree(data))
    text = "a qwrtzpsd qwrtzpsd, qwrtzpsd. qwrtzpsd!? x\nqwrtzpsd qwrtzpsd's qwrtzpsd1 qwrtzpsd́"
    parts = byte_bpe.Stretches(bpe).of(text)
    assert asked.count(b" qwrtzpsd") == 1
    assert b"".join(ids for ids, _ in parts).split() == [b"%d" % i for i in bpe.encode(text)] and b"".join(x for _, x in parts) == text.encode()
