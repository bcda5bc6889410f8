"""Removal of word sequences that an earlier document holds, by a compacted de Bruijn graph.

A window of WINDOW words is an edge from its first WINDOW - 1 words to its last ones. Only edges
that may repeat are built. Hashes of SAMPLE words are sampled so that equal windows sample the same one
(the least of each window); windows whose sample occurs in one text only can't repeat. The other
windows are dealt by hash, and each occurrence gets a source: the first occurrence in a smaller
doc_id. Where a document follows its source from edge to edge without a branch, the edges are
compacted into one path with coordinates in both documents. A join of the paths with digests of the
words at both coordinates verifies each path before its words go.

Texts of equal words are one text, that of the least doc_id, until the end. Within a block of
documents, an edge sends one document's occurrences to its hash; the others of the block know their
source already. So an edge in every document has a row for each block, not for each document.

Defined cases: null is the empty text; a text of fewer words than a window keeps them all; rows
without doc_id keep their words and are no source; rows that share a doc_id are no sources for each
other; repeated rows are all returned alike; other columns are not read. Blocks depend on what a
task reads, results don't.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.block_sums import sliced
from stratamart.llm.common import Batches, text_bytes, written

WINDOW = 13
SAMPLE = 7
_FACTS = "doc_id long, copy long, check long, n_words long, words_sha256 string"
_SAMPLES = "sample long, salt long, copy long, known boolean"
_EDGES = "edge long, check int, salt long, doc_id long, part int, at int, src_id long, src_at int"
_PATH = ("doc_id", "part", "start", "n", "src_id", "src_start")


def _mixed(hashes: np.ndarray, width: int, factor: int) -> np.ndarray:
    """A hash of each run of `width` words."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(factor) + hashes[j : n + j]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def samples(hashes: np.ndarray) -> np.ndarray:
    """For each window the least hash of the runs of SAMPLE words in it."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.uint64)
    runs = _mixed(hashes, SAMPLE, 0x9E3779B97F4A7C15)
    return np.lib.stride_tricks.sliding_window_view(runs, WINDOW - SAMPLE + 1).min(axis=1)


def _digest(words: list[bytes]) -> tuple[bytes, int, int]:
    joined = b" ".join(words)
    whole = hashlib.blake2b(joined, digest_size=16).digest()
    copy, check = np.frombuffer(whole, "<i8").tolist()
    return joined, copy, check


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def facts(docs: DataFrame) -> DataFrame:
    """Number and digests of the words of each document; equal words have equal copy and check."""

    def run(batches: Batches):
        for batch in batches:
            rows = []
            for text in text_bytes(batch):
                words = text.split()
                joined, copy, check = _digest(words)
                rows.append((copy, check, len(words), hashlib.sha256(joined).hexdigest()))
            yield _batch(_FACTS, batch.column("doc_id").cast(pa.int64()), *(zip(*rows, strict=True) if rows else [()] * 4))

    return docs.select("doc_id", "text").mapInArrow(run, _FACTS)


def _sampled(docs: DataFrame) -> DataFrame:
    """Samples with the texts they occur in; salt 0 goes to the sample's group, others are known to recur."""

    def run(batches: Batches):
        for batch in (part for whole in batches for part in sliced(whole)):
            found, copies = [np.zeros((2, 0), np.int64)], set()
            for text in text_bytes(batch):
                words = text.split()
                copy = _digest(words)[1]
                if copy not in copies:
                    copies.add(copy)
                    own = np.unique(samples(word_hashes(words))).view(np.int64)
                    found.append(np.stack([own, np.full(len(own), copy)]))
            sample, copy = np.concatenate(found, axis=1)
            order = np.lexsort((copy, sample))
            sample, copy = sample[order], copy[order]
            first = np.concatenate([[True], sample[1:] != sample[:-1]])[: len(sample)]
            place = np.arange(len(sample)) - np.maximum.accumulate(np.where(first, np.arange(len(sample)), 0))
            known = (place > 0) | np.concatenate([place[1:] > 0, [False]])[: len(sample)]
            yield _batch(_SAMPLES, sample, np.where(place > 1, copy | 1, 0), copy, known)

    return docs.select("text").mapInArrow(run, _SAMPLES)


def _shared(docs: DataFrame) -> DataFrame:
    """copy and the samples of its text that occur in another text, too."""
    group = Window.partitionBy("sample", "salt")
    found = _sampled(docs).select("sample", "copy", "known", F.min("copy").over(group).alias("low"), F.max("copy").over(group).alias("high"))
    # a text's own windows bound the size of its set
    return found.where("known or low <> high").groupBy("copy").agg(F.collect_set("sample").alias("samples"))


def _candidates(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, part, text and samples of one document of each text that shares a sample."""
    one = known.where("doc_id is not null and part is not null")
    found = one.join(_shared(docs), "copy").select("doc_id", "part", "copy", "samples")

    def run(batches: Batches):
        for batch in batches:
            copies = [_digest(text.split())[1] for text in text_bytes(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(copies, pa.int64()), batch.column("text").cast(pa.string())], ["doc_id", "copy", "text"])

    # rows that share a doc_id may have other texts, so both name the row
    named = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "doc_id long, copy long, text string")
    return named.join(found, ["doc_id", "copy"]).select("doc_id", "part", "samples", "text")


def _edges(texts: DataFrame) -> DataFrame:
    """Occurrences of the edges that may repeat; src_id is set where the block has an earlier one."""

    def run(batches: Batches):
        for batch in (part for whole in batches for part in sliced(whole)):
            parts = []
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("samples"), text_bytes(batch), strict=True)
            for doc_id, part, shared, text in rows:
                hashes = word_hashes(text.split())
                at = np.flatnonzero(np.isin(samples(hashes).view(np.int64), shared.values.to_numpy()))
                edge, check = (_mixed(hashes, WINDOW, factor)[at].view(np.int64) for factor in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
                parts.append(np.stack([edge, check & 0x7FFFFFFF, np.full(len(at), doc_id), np.full(len(at), part), at]))
            if not parts:
                continue
            edge, check, doc_id, part, at = rows = np.concatenate(parts, axis=1)
            rows = edge, check, doc_id, part, at = rows[:, np.lexsort((at, part, doc_id, check, edge))]
            index = np.arange(len(edge))
            first = np.concatenate([[True], (edge[1:] != edge[:-1]) | (check[1:] != check[:-1])])[: len(edge)]
            head = np.maximum.accumulate(np.where(first, index, 0))
            known = doc_id != doc_id[head]
            src = [pa.array(x, mask=~known) for x in (doc_id[head], at[head].astype(np.int32))]
            yield _batch(_EDGES, edge, check.astype(np.int32), np.where(known, (index << 1) | 1, 0), doc_id, part.astype(np.int32), at.astype(np.int32), *src)

    return texts.mapInArrow(run, _EDGES)


def _paths(edges: DataFrame) -> DataFrame:
    """Unbranched paths of repeated edges: n edges from `start` that follow the source from `src_start`."""
    same = Window.partitionBy("edge", "check", "salt")
    first = F.min(F.struct("doc_id", "at")).over(same)
    found = edges.select("doc_id", "part", "at", "src_id", "src_at", first.alias("first"))
    found = found.select("doc_id", "part", "at", F.coalesce("src_id", "first.doc_id").alias("src_id"), F.coalesce("src_at", "first.at").alias("src_at"))
    found = found.where("src_id < doc_id")
    along = Window.partitionBy("doc_id", "part").orderBy("at")
    follows = (F.lag("at").over(along) == F.col("at") - 1) & (F.lag("src_id").over(along) == F.col("src_id")) & (F.lag("src_at").over(along) == F.col("src_at") - 1)
    found = found.withColumn("opens", F.when(follows, 0).otherwise(1))
    found = found.withColumn("path", F.sum("opens").over(along))
    return found.groupBy("doc_id", "part", "path").agg(
        F.min("at").alias("start"), F.count("*").cast("int").alias("n"), F.min("src_id").alias("src_id"), F.min("src_at").alias("src_start")
    ).select(*_PATH)


def _span_digests(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """Digests of the words under the given edges: doc_id, start, n, part."""
    wanted = spans.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("wanted"))
    joined = texts.select("doc_id", "part", "text").join(wanted, "doc_id")

    def run(batches: Batches):
        for batch in batches:
            rows = []
            for doc_id, part, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text", "wanted")), strict=True):
                words = (text or "").encode().split()
                for x in wanted:
                    start, n = x["start"], x["n"]
                    if start + n + WINDOW - 1 <= len(words):
                        own = hashlib.blake2b(b" ".join(words[start : start + n + WINDOW - 1]), digest_size=16).digest()
                        rows.append((doc_id, part, start, n, own))
            yield _batch(_DIGESTS, *(zip(*rows, strict=True) if rows else [()] * 5))

    return joined.mapInArrow(run, _DIGESTS)


_DIGESTS = "doc_id long, part int, start int, n int, digest binary"


def _verified(texts: DataFrame, paths: DataFrame) -> DataFrame:
    """The paths whose words are those at the source's coordinates."""
    spans = paths.select("doc_id", "start", "n").union(paths.select("src_id", "src_start", "n"))
    digests = written(_span_digests(texts, spans), "span-digests")
    own = paths.join(digests, ["doc_id", "part", "start", "n"])
    source = digests.select(F.col("doc_id").alias("src_id"), F.col("start").alias("src_start"), "n", "digest").distinct()
    return own.join(source, ["src_id", "src_start", "n", "digest"], "left_semi").select(*_PATH)


def repeated_paths(docs: DataFrame, texts: DataFrame) -> DataFrame:
    paths = written(_paths(_edges(texts)), "paths")
    return _verified(texts, paths)


def covered(n_words: int, spans: Iterator[tuple[int, int]]) -> np.ndarray:
    """Marks the words under the edges of the spans (start, number of edges)."""
    marks = np.zeros(n_words + 1, np.int64)
    for start, n in spans:
        marks[start] += 1
        marks[min(n_words, start + n + WINDOW - 1)] -= 1
    return np.cumsum(marks)[:n_words] > 0


_CUT = "doc_id long, part int, removed long, kept_sha256 string, kept string"


def _cut(texts: DataFrame, paths: DataFrame, with_text: bool) -> DataFrame:
    spans = paths.groupBy("doc_id", "part").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = texts.select("doc_id", "part", "text").join(spans, ["doc_id", "part"])

    def run(batches: Batches):
        for batch in batches:
            rows = []
            for doc_id, part, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text", "spans")), strict=True):
                words = (text or "").encode().split()
                gone = covered(len(words), ((x["start"], x["n"]) for x in spans))
                left = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                rows.append((doc_id, part, int(gone.sum()), hashlib.sha256(left).hexdigest(), left.decode() if with_text else None))
            yield _batch(_CUT, *(zip(*rows, strict=True) if rows else [()] * 5))

    cut = joined.mapInArrow(run, _CUT)
    # rows that share doc_id and words came here each
    return cut.groupBy("doc_id", "part").agg(*[F.first(c).alias(c) for c in ("removed", "kept_sha256", "kept")])


def deduplicated(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """n_words, n_removed and the digest of the kept words of each document; if wanted, `kept`, the kept
    words joined by one space, null where none is removed."""
    own = written(facts(docs), "word-facts")
    least = own.groupBy("copy", "check").agg(F.min("doc_id").alias("least_id"))
    parts = least.where("least_id is not null").withColumn("part", (F.row_number().over(Window.partitionBy("least_id").orderBy("copy", "check")) - 1).cast("int"))
    parts = written(parts, "texts")  # one row for each text that differs in its words
    texts = written(_candidates(docs, parts.withColumnRenamed("least_id", "doc_id")), "candidate-texts")
    cut = _cut(texts, repeated_paths(docs, texts), with_text).withColumnRenamed("doc_id", "least_id")
    cut = parts.join(cut, ["least_id", "part"], "left").drop("part")
    judged = own.join(cut, ["copy", "check"], "left")
    later = F.coalesce((F.col("doc_id") > F.col("least_id")) & (F.col("n_words") >= WINDOW), F.lit(False))
    first = F.coalesce(F.col("doc_id") == F.col("least_id"), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    return judged.select(
        "doc_id", "n_words",
        F.when(later, F.col("n_words")).when(first, F.coalesce("removed", F.lit(0))).otherwise(0).cast("long").alias("n_removed"),
        F.when(later, F.lit(nothing)).when(first, F.coalesce("kept_sha256", "words_sha256")).otherwise(F.col("words_sha256")).alias("kept_sha256"),
        *([F.when(later, F.lit("")).when(first, F.col("kept")).alias("kept")] if with_text else []),
    )
