"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: the encoding of a concatenation follows from the
encodings of both parts. A match of the pattern is halved down to leaves of LEAF_BYTES, whose bytes are
merged directly. Two neighbours are joined by encoding a window anew: some tokens on either side of
the border, twice as many at each try. Tokens outside the window are final as soon as the token on
each side of each window edge is a stable pair, that is, encoding the bytes of the two alone gives
the same two: a sequence whose neighbours are all stable pairs is the encoding of its bytes. Decoding concatenates
the bytes of the tokens in the same way. Equal stretches of text are encoded once for each worker.

Defined cases: null is the empty text, which has no tokens; a match without spaces may be as long
as the text; repeated rows each give a row; other columns are not read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stratamart.llm.common import Batches, Cache, latin

LEAF_BYTES = 4
FIRST_WINDOW = 2
#: Parts and windows up to this length are remembered.
_SHORT = 12
#: A single match is remembered up to this length.
_LONGEST = 64
#: Signs that, after letters, are a match of their own.
_TRAILING = ".,;:!?*&$%#"
#: A space between two other characters, of which neither is white space, always begins a match.
_SAFE = re.compile(r"(?<=\S) (?=\S)")


class TreeBpe:
    """Encodes and decodes by the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.stable = Cache(lambda pair: self.merged(pair[0] + pair[1]) == [*pair], 100_000)
        self.windows, self.trees = Cache(self._merged, 100_000), Cache(self.tree, 100_000)
        self.joins = 0

    def merged(self, data: bytes) -> list[bytes]:
        return self.windows[data] if len(data) <= _SHORT else self._merged(data)

    def _merged(self, data: bytes) -> list[bytes]:
        """Merge the pair of lowest rank, the leftmost of equals, until none is left."""
        get, none = self.ranks.get, len(self.ranks)
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            parts[i : i + 2] = [both := parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(both + parts[i + 1], none)
            if i:
                ranks[i - 1] = get(parts[i - 1] + both, none)
        return parts

    def tree(self, data: bytes) -> list[bytes]:
        """The tokens of one match: halves, then their join. Short parts recur and are remembered."""
        if data in self.ranks:  # each token of the vocabulary is its own encoding
            return [data]
        if len(data) <= LEAF_BYTES:
            return self._merged(data)
        half = len(data) // 2
        parts = data[:half], data[half:]
        return self.join(*(self.trees[x] if len(x) <= _SHORT else self.tree(x) for x in parts))

    def join(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The encoding of the concatenation of two encoded byte strings."""
        self.joins += 1
        if not left or not right or self.stable[left[-1], right[0]]:
            return left + right
        take = FIRST_WINDOW
        while True:
            start, end = max(0, len(left) - take), min(len(right), take)
            window = self.merged(b"".join(left[start:] + right[:end]))
            settled_left = start == 0 or self.stable[left[start - 1], window[0]]
            settled_right = end == len(right) or self.stable[window[-1], right[end]]
            if settled_left and settled_right:
                return left[:start] + window + right[end:]
            take *= 2

    def encode(self, text: str) -> list[int]:
        """The ids of a text, each match of the pattern encoded on its own."""
        return [self.ranks[token] for match in self.pattern.findall(text) for token in self.tree(match.encode())]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 32:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> TreeBpe:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return TreeBpe(ranks, pattern)


#: Stands for a word that white space borders on more than one side.
UNSAFE = (b"", b"")


class Stretches:
    """Ids as text, one space after each, and the bytes they decode to, for stretches of texts.

    Texts are cut where a match must begin; each part is encoded on its own.
    """

    def __init__(self, bpe: TreeBpe):
        def of_match(match: str) -> tuple[bytes, bytes]:
            ids = [bpe.ranks[token] for token in bpe.tree(match.encode())]
            return b"".join(map(written.__getitem__, ids)), bpe.decode(ids)

        written = [b"%d " % i for i in range(len(bpe.ranks))]
        matches, cut = Cache(of_match, 200_000), bpe.pattern.findall

        def made(stretch: str) -> tuple[bytes, bytes]:
            found = cut(stretch)
            if len(found) == 1:
                return matches[stretch] if len(stretch) <= _LONGEST else of_match(stretch)
            ids, decoded = zip(*map(matches.__getitem__, found), strict=True)
            return b"".join(ids), b"".join(decoded)

        def spaced(word: str) -> tuple[bytes, bytes]:
            if not word or word[0].isspace() or word[-1].isspace():
                return UNSAFE
            stem = word.rstrip(_TRAILING)
            if not latin(stem):
                return made(" " + word)
            if len(stem) == len(word):
                return matches[" " + word]
            (ids, decoded), (own, signs) = matches[" " + stem], matches[word[len(stem) :]]
            return ids + own, decoded + signs

        self.any, self.spaced = Cache(made, 20_000), Cache(spaced, 200_000)

    def of(self, text: str) -> list[tuple[bytes, bytes]]:
        if not text:
            return []
        first, *words = text.split(" ")
        if first and not first[-1].isspace():
            parts = list(map(self.spaced.__getitem__, words))
            if UNSAFE not in parts:
                return [self.any[first], *parts]
        first, *words = _SAFE.split(text)
        return [self.any[first], *(self.any[" " + x] for x in words)]


@lru_cache(maxsize=2)
def _stretches(path: str, pattern: str) -> Stretches:
    return Stretches(vocabulary(path, pattern))


def _digests(batch: pa.RecordBatch, known: Stretches) -> pa.RecordBatch:
    rows = []
    for text in batch.column("text").to_pylist():
        parts = known.of(text or "")
        ids, decoded = map(b"".join, zip(*parts)) if parts else (b"", b"")
        rows.append((ids.count(b" "), *(hashlib.sha256(x).hexdigest() for x in (ids.rstrip(), decoded))))
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").cast(pa.int64()), pa.array(columns[0], pa.int64()), *(pa.array(x, pa.string()) for x in columns[1:])],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def round_trips(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of the bytes they decode to, for each document."""

    def run(batches: Batches):
        known = _stretches(path, pattern)
        gc.disable()  # caches hold very many lists and no cycles
        try:
            for batch in batches:
                yield _digests(batch, known)
        finally:
            gc.enable()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of each document."""

    def run(batches: Batches):
        bpe = vocabulary(path, pattern)
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of each list of ids; null is the empty list."""

    def run(batches: Batches):
        bpe = vocabulary(path, pattern)
        for batch in batches:
            data = [bpe.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(data, pa.binary())], ["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")
