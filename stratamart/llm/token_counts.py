"""Token counts without token ids: pieces per distinct pre-token, joined to pre-token frequencies.

The distinct pre-tokens of the corpus are counted, and the pieces of each are counted once. That table is joined to the
frequencies of pre-tokens within documents, and the products are added up. The most frequent pre-tokens, those of the
highest classes of counts that have MOST_KNOWN members at most, are broadcast and joined where texts are read; a
corpus with no more has all of its pre-tokens joined there. The frequencies of all others go, in blocks of
documents, through a shuffled join (see block_sums). So what is shuffled twice is the tail of rare pre-tokens only.

In the broadcast table a pre-token stands as 96 bits of its hash.

Defined cases: null is the empty text, with no tokens; strings of added tokens inside texts count as
one token each, as the tokenizer's default has it; repeated rows each give a row, and a null doc_id
stays null; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm.block_sums import in_blocks, numbering, packed, sliced, summed
from stratamart.llm.common import Batches, Cache, latin_pretoken, text_bytes, written

OVER_LIMIT = 2048
#: Pre-tokens that are broadcast, 16 bytes each: 64 MB.
MOST_KNOWN = 4_000_000
#: A task hands on its counted words when it has so many distinct ones.
_WORDS = 300_000
_TRAILING = b".,;:!?*&$%#"
_OWN = "doc_id long, n_bytes long, n_known long"


class Pieces:
    """Pre-tokens of words, and the number of pieces of a pre-token, by the tokenizer's own parts."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = set(added)
        self._cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.of_word, self.of_tail = Cache(self._of_word, 40_000), Cache(self._pretokens, 5_000)

    def _of_word(self, word: bytes) -> list[str]:
        """Latin letters are one pre-token in lower case, and punctuation never joins a letter before it."""
        stem = word.rstrip(_TRAILING)
        one = stem.decode().lower() if stem.isalpha() else latin_pretoken(stem.decode())
        if one is not None:
            return [one, *(self.of_tail[word[len(stem) :]] if len(stem) < len(word) else [])]
        return self._pretokens(word)

    def _pretokens(self, word: bytes) -> list[str]:
        text, out = word.decode(), []
        for part in self._cut.split(text) if self._cut else [text]:
            if part in self.added:
                out.append(part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
                out += [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return out

    def count(self, pretoken: str) -> int:
        return 1 if pretoken in self.added else len(self.tokenizer.model.tokenize(pretoken))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Known:
    """Pieces of the broadcast pre-tokens, found by their hash."""

    def __init__(self, low: np.ndarray, high: np.ndarray, n_tokens: np.ndarray):
        order = np.argsort(low, kind="stable")
        self.low, self.high, self.n_tokens = low[order], high[order], n_tokens[order]

    def of(self, names: list[bytes]) -> np.ndarray:
        """The pieces of each pre-token, -1 if it isn't here."""
        low, high = hashes(names)
        at = np.minimum(np.searchsorted(self.low, low), max(0, len(self.low) - 1))
        if not len(self.low):
            return np.full(len(names), -1)
        return np.where((self.low[at] == low) & (self.high[at] == high), self.n_tokens[at].astype(np.int64), -1)


def hashes(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The lower 64 and the next 32 bits of each name's hash."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, names)), ">u8").reshape(-1, 2)
    return digests[:, 1].astype(np.uint64), (digests[:, 0] & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def pretokens(docs: DataFrame, path: str) -> DataFrame:
    """key and how often it occurs, for each distinct pre-token of the documents."""

    def handed_on(words: Counter, known: Pieces) -> pa.RecordBatch:
        counts: dict[str, int] = {}
        for word, n in words.items():
            for name in known.of_word[word]:
                counts[name] = counts.get(name, 0) + n
        return pa.RecordBatch.from_arrays([pa.array([x.encode() for x in counts], pa.binary()), pa.array(counts.values(), pa.int64())], ["key", "n"])

    def run(batches: Batches):
        known, words = pieces(path), Counter()
        for batch in batches:
            for part in sliced(batch):
                for text in text_bytes(part):
                    words.update(text.split())
                if len(words) > _WORDS:
                    yield handed_on(words, known)
                    words = Counter()
        yield handed_on(words, known)

    return docs.select("text").mapInArrow(run, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n"))


def counted(found: DataFrame, path: str) -> DataFrame:
    """The number of pieces of each pre-token, with its occurrences."""

    def run(batches: Batches):
        known = pieces(path)
        for batch in batches:
            n_tokens = [known.count(x.decode()) for x in batch.column("key").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(n_tokens, pa.int64())], ["key", "n", "n_tokens"])

    return written(found.select("key", "n").mapInArrow(run, "key binary, n long, n_tokens long"), "pieces")


def frequent(table: DataFrame) -> tuple[Known, int]:
    """The pre-tokens of the highest classes of counts, and the least count that they have; 0 if these are all."""

    def hashed(batches: Batches):
        for batch in batches:
            low, high = hashes(batch.column("key").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(low.view(np.int64)), pa.array(high.astype(np.int64)), batch.column("n_tokens")], ["low", "high", "n_tokens"])

    sizes = {r["class"]: r["size"] for r in table.groupBy(F.floor(F.log2("n")).alias("class")).agg(F.count("*").alias("size")).collect()}
    taken, least = 0, 0
    for at in sorted(sizes, reverse=True):
        if taken + sizes[at] > MOST_KNOWN:
            least = 1 << (at + 1)
            break
        taken += sizes[at]
    rows = table.where(F.col("n") >= least).select("key", "n_tokens").mapInArrow(hashed, "low long, high long, n_tokens long").toArrow()
    columns = [rows.column(x).to_numpy() for x in ("low", "high", "n_tokens")]
    return Known(columns[0].view(np.uint64), columns[1].astype(np.uint32), columns[2].astype(np.int32)), least


def _words_of(texts: list[bytes], known: Pieces):
    """For a block: pre-tokens, their numbers word by word, each word's number of them, and the words of each text."""
    words, names, found = numbering(), numbering(), []
    for text in texts:
        own = text.split()
        found.append(np.fromiter(map(words.__getitem__, own), np.int32, len(own)))
    parts = [[names[x] for x in known.of_word[word]] for word in words]
    length = np.fromiter(map(len, parts), np.int32, len(parts))
    flat = np.fromiter((x for part in parts for x in part), np.int32, int(length.sum()))
    return [x.encode() for x in names], flat, length, found


def block_frequencies(texts: list[bytes], known: Pieces, table: Known) -> tuple[list[bytes], pa.Array, np.ndarray, np.ndarray]:
    """Of a block: pre-tokens that the table lacks, with packed entries and occurrences, and each text's pieces of the others.

    White space is dropped by this tokenizer, so a text's pre-tokens are those of its words.
    """
    names, flat, length, found = _words_of(texts, known)
    n_tokens = table.of(names)
    sums = np.concatenate([[0], np.cumsum(np.maximum(n_tokens, 0)[flat])])[np.concatenate([[0], np.cumsum(length)])]
    of_word = np.diff(sums)
    n_known = np.array([int(of_word[x].sum()) for x in found], np.int64)
    # what is not there stays in the flat lists, under new numbers
    absent = n_tokens < 0
    number, kept = np.cumsum(absent) - 1, absent[flat]
    length = np.diff(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(length)])]).astype(np.int32)
    flat = number[flat[kept]]
    starts = np.cumsum(length) - length
    sizes = [int(length[x].sum()) for x in found]
    word = np.concatenate(found) if found else np.zeros(0, np.int32)
    each = length[word]
    inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    rest = [x for x, gone in zip(names, absent.tolist(), strict=True) if gone]
    return rest, *packed(flat[np.repeat(starts[word], each) + inside], sizes, len(rest)), n_known


def token_counts(docs: DataFrame, path: str, limit: int = OVER_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether they are over the limit, for each document."""
    table = counted(pretokens(docs, path), path)
    known, least = frequent(table)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def read(part: pa.RecordBatch):
        texts = text_bytes(part)
        names, entries, totals, n_known = block_frequencies(texts, pieces(path), shared.value)
        columns = {"doc_id": part.column("doc_id"), "n_bytes": pa.array(map(len, texts), pa.int64()), "n_known": pa.array(n_known, pa.int64())}
        return pa.array(names, pa.binary()), entries, totals, columns

    def whole(batches: Batches):
        for batch in batches:
            for part in sliced(batch):
                columns = read(part)[3]
                yield pa.RecordBatch.from_arrays([x.cast(pa.int64()) for x in columns.values()], list(columns))

    if least:
        blocks = in_blocks(docs, read, _OWN, "pretokens")
        found = summed(blocks, table.where(F.col("n") < least).select("key", "n_tokens"), _OWN)
    else:
        found = docs.select("doc_id", "text").mapInArrow(whole, _OWN).withColumn("n_tokens", F.lit(0))
    n_tokens = F.col("n_known") + F.col("n_tokens")
    return found.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
