"""Small helpers that the operators share."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import new_folder, shuffles_dropped

Batches = Iterator[pa.RecordBatch]


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a table in the folder that all executors share; cuts the lineage.

    The shuffle files behind it are no longer needed, so Spark is told to drop those of this write when it ends.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(batch: pa.RecordBatch) -> list[bytes]:
    """The column text as UTF-8; null is the empty text."""
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package: from where the driver has it if they run on its machine, else as an archive."""
    context, root = spark.sparkContext, Path(__file__).resolve().parents[2]
    if not context.master.startswith("local"):
        if _ARCHIVE not in map(os.path.basename, context.listFiles):
            context.addPyFile(packed_package(root, tempfile.mkdtemp()))  # the driver serves it to the others
        return
    environment = context.environment
    paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
    if str(root) not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([str(root), *paths])


_ARCHIVE = "stratamart.zip"


def packed_package(root: Path, folder: str) -> str:
    """An archive of the package that Python can import from."""
    with zipfile.ZipFile(path := os.path.join(folder, _ARCHIVE), "w") as archive:
        for file in sorted(root.glob("stratamart/**/*.py")):
            archive.write(file, file.relative_to(root))
    return path


def one_label(labels: DataFrame) -> DataFrame:
    """doc_id and quality, once for each id that has a quality; ids with both are left out."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
    return known.agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").drop("other")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no column of df."""
    taken, out = {x.lower() for x in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Letters that one lower-case letter stands for, whatever the version of Unicode; none combines with another.
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
_LETTERS = byte_letters()


def latin(word: str) -> bool:
    return _LATIN.fullmatch(word) is not None


def latin_pretoken(word: str) -> str | None:
    """A word of Latin letters as a lower-casing byte-level tokenizer cuts and writes it: as one pre-token."""
    return word.lower().encode().decode("latin-1").translate(_LETTERS) if _LATIN.fullmatch(word) else None


class Cache(dict):
    """Values by key, made on first use. At most 2 * `most` stay: when the younger half is full it
    becomes the older one, and keys that are not asked for again are dropped with it."""

    def __init__(self, make: Callable, most: int = 180_000):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = self.copy()
            self.clear()
        self[key] = value
        return value
