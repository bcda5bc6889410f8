"""Sums per document of a value that each distinct key has, by way of blocks of documents.

Texts are read in blocks of at most MOST_BYTES. A block gives one row for each of its distinct keys, with the
places of the documents that hold it and how often, packed, and one row for each document. The keys'
rows are joined to a table of values, made once for each distinct key of the corpus; the products go back to their
blocks and are added up there, a block at a time. A key in every document has one row for each block, and
Spark splits the partition of such a key in the join. No partial sum is ever a row for a document and a key.

Blocks are written before they are used, as their numbers come from the task that reads them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Batches, partitions, written

MOST_BYTES, MOST_ROWS = 8 << 20, 1 << 16
#: One packed entry: the document's place in its block, and a count.
ENTRY = np.dtype([("place", "<u2"), ("count", "<u4")])
_KINDS = {"block": pa.int64(), "key": pa.binary(), "entries": pa.binary(), "total": pa.int64(), "place": pa.int32()}
_SCHEMA = "block long, key binary, entries binary, total long, place int"


def sliced(batch: pa.RecordBatch, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most `most` bytes of text, MOST_BYTES if not given, or one text."""
    most = most or MOST_BYTES
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        end = min(end, start + MOST_ROWS)
        yield batch.slice(start, end - start)
        start = end


def numbering() -> defaultdict:
    """Numbers for keys, from 0, in the order in which they are first asked for."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def packed(keys: np.ndarray, sizes: list[int], n_keys: int) -> tuple[pa.Array, np.ndarray]:
    """For each key its packed entries and how often it occurs; `keys` are those of all documents, one after another."""
    place = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    both, counts = np.unique((keys.astype(np.int64) << 16) | place, return_counts=True)
    del place
    entries = np.empty(len(both), ENTRY)
    entries["place"], entries["count"] = both & 0xFFFF, counts
    numbers = both >> 16
    ends = np.concatenate([[0], np.cumsum(np.bincount(numbers, minlength=n_keys) * ENTRY.itemsize)]).astype(np.int32)
    totals = np.bincount(numbers, weights=counts, minlength=n_keys).astype(np.int64)
    return pa.Array.from_buffers(pa.binary(), n_keys, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(entries.tobytes())]), totals


def in_blocks(docs: DataFrame, read: Callable, own: str, label: str) -> DataFrame:
    """The written blocks of the documents.

    `read` takes a slice and gives its keys, their packed entries and totals, and for each document the columns
    that `own` names.
    """
    names = [x.split()[0] for x in own.split(", ")]
    own_kinds = {f.name: f.dataType for f in docs.sparkSession.createDataFrame([], own).schema}
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = _KINDS | {n: to_arrow_type(own_kinds[n]) for n in names}

    def rows(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(n, kind)).cast(kind) for k, kind in kinds.items()], list(kinds))

    def run(batches: Batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in sliced(batch):
                keys, entries, totals, columns = read(part)
                block, number = number, number + 1
                if len(keys):
                    yield rows(len(keys), {"block": pa.array(np.full(len(keys), block)), "key": keys, "entries": entries, "total": pa.array(totals)})
                n = part.num_rows
                yield rows(n, {"block": pa.array(np.full(n, block)), "place": pa.array(range(n), pa.int32()), **columns})

    return written(docs.select("doc_id", "text").mapInArrow(run, f"{_SCHEMA}, {own}"), label)


def summed(blocks: DataFrame, values: DataFrame, own: str) -> DataFrame:
    """For each document its own columns and, for each column of `values` but the key, the sum over its keys."""
    sums = [c for c in values.columns if c != "key"]
    names = [x.split()[0] for x in own.split(", ")]
    spark = blocks.sparkSession

    def run(batches: Batches):
        block, totals = None, None
        for batch in batches:
            seen = batch.column("block").to_numpy()
            starts = [0, *(np.flatnonzero(seen[1:] != seen[:-1]) + 1).tolist(), len(seen)] if len(seen) else []
            for start, end in zip(starts, starts[1:]):
                part = batch.slice(start, end - start)
                if seen[start] != block:
                    block, totals = seen[start], np.zeros((len(sums), MOST_ROWS), np.int64)
                held = part.filter(pc.is_null(part.column("place")))
                if held.num_rows:
                    entries = np.frombuffer(b"".join(held.column("entries").to_pylist()), ENTRY)
                    counts = pc.binary_length(held.column("entries")).to_numpy() // ENTRY.itemsize
                    for i, name in enumerate(sums):
                        weights = np.repeat(held.column(name).to_numpy(), counts) * entries["count"].astype(np.int64)
                        np.add.at(totals[i], entries["place"], weights)
                docs = part.filter(pc.is_valid(part.column("place")))
                if docs.num_rows:
                    places = docs.column("place").to_numpy()
                    yield pa.RecordBatch.from_arrays([*(docs.column(x) for x in names), *(pa.array(t[places]) for t in totals)], [*names, *sums])

    held = blocks.where("key is not null").select("key", "block", "entries").join(values, "key")
    held = held.select("block", F.lit(None).cast("int").alias("place"), "entries", *sums, *(F.lit(None).cast(blocks.schema[x].dataType).alias(x) for x in names))
    docs = blocks.where("place is not null").select("block", "place", F.lit(None).cast("binary").alias("entries"), *(F.lit(None).cast("long").alias(x) for x in sums), *names)
    # a block's keys come before its documents
    together = held.union(docs).repartition(partitions(spark), "block").sortWithinPartitions("block", F.col("place").asc_nulls_first())
    return together.mapInArrow(run, ", ".join([own, *(f"{x} long" for x in sums)]))
