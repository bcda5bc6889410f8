"""Best-fit packing planned on the histogram of lengths.

Documents become pieces of at most `size` tokens. Only the histogram of piece lengths, at most
`size` rows, goes to the driver, where best fit, longest first, runs over counts: all open sequences
of one history are one entry, and an entry takes a whole batch of equal pieces in one step. An entry
is split at most twice for each length, so the plan has O(size) rows whatever the number of pieces.
Each piece then takes its planned slot by its rank within its length. Ranks come from counts over
hash slots of the documents, so pieces of one length need not meet in one task.

Defined cases: null is the empty text, a piece of one token (the end mark); repeated rows are packed
one by one; a null doc_id stays null; without documents there are no pieces; other columns are not
read.
"""

from __future__ import annotations

import os
import struct
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratamart.llm.common import Batches, Cache, latin_pretoken, partitions, text_bytes, written

SIZE = 2048
END_ID = 0
_TRAILING = b".,;:!?*&$%#"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLAN = "length long, first long, last long, per_sequence long, first_sequence long, base long"


class WordIds:
    """Packed ids of words; this tokenizer drops white space, so a text's ids are those of its words.

    It also lowers case and never lets punctuation after a letter or digit join it, so a word
    is known by its lower-case stem and the punctuation behind it, unless it may hold an added token.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.added)  # no word without it holds one
        self.of_stem, self.of_word = Cache(self._encoded), Cache(self._joined, 260_000)

    def _encoded(self, part: bytes) -> bytes:
        text = part.decode()
        one = text if part.isalpha() and part.islower() else latin_pretoken(text)
        if one is not None:  # one pre-token
            ids = [token.id for token in self.tokenizer.model.tokenize(one)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _joined(self, word: bytes) -> bytes:
        if self.mark in word.lower() and any(x in word.lower() for x in self.added):
            return self._encoded(word)
        stem = word.rstrip(_TRAILING)
        if stem[-1:].isalnum() or latin_pretoken(stem.decode()):  # for bytes these are ASCII letters and digits
            return self.of_stem[stem.lower()] + (self.of_stem[word[len(stem) :]] if len(stem) < len(word) else b"")
        return self.of_stem[word]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> Cache:
    return WordIds(path).of_word


def token_pieces(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: place, length, checksum of the ids and, if wanted, the ids."""

    def run(batches: Batches):
        known = _word_ids(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), text_bytes(batch), strict=True):
                ids = b"".join([*map(known.__getitem__, text.split()), end])
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[at : at + 4 * size]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), np.frombuffer(own, "<i4") if with_ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = _PIECES + ", ids array<int>" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def planned(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts: ranges of ranks within a length, and the sequences that take them.

    Rows are (length, first, last, per_sequence, first_sequence, base): the piece of rank r, first <=
    r < last, goes to sequence first_sequence + (r - first) // per_sequence, at offset base + length
    * ((r - first) % per_sequence).
    """
    room: list[int] = []  # free places of open entries, ascending
    entries: dict[int, list[tuple[int, int]]] = {}  # by free places: (first sequence, number of sequences)
    plan, sequences = [], 0

    def opened(free: int, first: int, n: int) -> None:
        if n and free:
            if free not in entries:
                insort(room, free)
                entries[free] = []
            entries[free].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(room, length)
            if at < len(room):
                free = room[at]
                first, n = entries[free].pop()
                if not entries[free]:
                    del entries[free], room[at]
            else:
                free, first, n = size, sequences, -(-left // (size // length))
                sequences += n
            fit = free // length
            full, rest = min(n, left // fit), 0
            if full:
                plan.append((length, rank, rank + full * fit, fit, first, size - free))
                opened(free - fit * length, first, full)
                rank, left = rank + full * fit, left - full * fit
            if full < n and left:  # the last pieces of this length don't fill a sequence's share
                rest = left
                plan.append((length, rank, rank + rest, rest, first + full, size - free))
                opened(free - rest * length, first + full, 1)
                rank, left = rank + rest, 0
            used = full + bool(rest)
            opened(free, first + used, n - used)
    return plan


def ranked(pieces: DataFrame, slots: int) -> DataFrame:
    """Adds the rank of each piece among those of its length, from 0, without gaps.

    Slots go by the pieces' own checksum as well, so that rows without doc_id don't meet in one; repeated rows
    of one text do, and rank in any order, as they are alike.
    """
    slotted = pieces.withColumn("slot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slots)))
    before = Window.partitionBy("length").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = slotted.groupBy("length", "slot").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy("length", "slot").orderBy("doc_id", "piece", "ids_crc32")
    placed = slotted.withColumn("inside", F.row_number().over(inside) - 1)
    return placed.join(sums, ["length", "slot"]).withColumn("rank", F.col("before") + F.col("inside")).drop("slot", "before", "inside")


def packed(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces, which should be a written table, with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `size` rows
    # at most about three ranges for each length, so the plan's size is bounded by `size`
    plan = spark.createDataFrame(planned(counts, size), _PLAN).withColumnRenamed("length", "of_length")
    at = F.col("rank") - F.col("first")
    fits = (F.col("length") == F.col("of_length")) & (at >= 0) & (F.col("rank") < F.col("last"))
    placed = ranked(pieces, partitions(spark)).join(F.broadcast(plan), fits)
    return placed.select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(at / F.col("per_sequence"))).alias("sequence_id"),
        (F.col("base") + F.col("length") * (at % F.col("per_sequence"))).alias("offset"),
    )


def pack(docs: DataFrame, path: str, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """Packs all documents into sequences of at most `size` tokens."""
    return packed(written(token_pieces(docs, path, size, with_ids), "pieces"), size)
