"""Readers for the raw delimited files; every column stays text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.schemas import BRONZE, raw_schema

#: Whole line of a row with too many or too few fields, else NULL.
MALFORMED = "malformed_line"
#: Name of the file that a row came from.
ROW_FILE = "_row_file"


class UnknownTable(ValueError):
    """The target is not a bronze table."""


class EmptySource(ValueError):
    """The source file holds no data rows."""


def read_raw(
    spark: SparkSession,
    table: str,
    path: str | list[str],
    mode: str = "quoted",
    stream: bool = False,
    files_per_batch: int = 1000,
    with_file: bool = False,
) -> DataFrame:
    """Rows of one source table, header line of each file skipped.

    Every row is kept. One with too many or too few fields has its whole line in MALFORMED; the
    fields that can be told apart are filled. A header that names other columns, or in another order, fails.

    ``quoted``     quote-aware; files are split between tasks.
    ``multiline``  quote-aware with line breaks inside fields (review texts). A file is one
                   task then, so such sources should come as many files.
    ``split``      plain split at every comma: quotes stay in the values and the last column
                   takes the rest of the line, which ends at a line feed only.

    With ``stream`` the path is a folder that new files arrive in, taken ``files_per_batch`` at
    a time.
    """
    if table not in BRONZE:
        raise UnknownTable(f"target bronze table does not exist: {table}")
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch) if stream else spark.read
    names = BRONZE[table]
    if mode == "split":
        # The text source ends a line at a line feed and knows no other special character.
        lines = reader.option("lineSep", "\n").text(path)
        plain = F.regexp_replace("value", '^\ufeff|["\r]', "")
        parts = F.split("value", ",", len(names))
        short = F.when(F.size(parts) < len(names), F.col("value"))
        columns = [F.get(parts, F.lit(i)).alias(name) for i, name in enumerate(names)] + [short.alias(MALFORMED)]
        rows = lines.where(plain != ",".join(names))
    elif mode in ("quoted", "multiline"):
        columns = [*names, MALFORMED]
        rows = (
            reader.schema(T.StructType([*raw_schema(table).fields, T.StructField(MALFORMED, T.StringType())]))
            .options(header=True, sep=",", quote='"', escape='"', encoding="UTF-8", multiLine=mode == "multiline")
            .options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, enforceSchema=False)
            .csv(path)
        )
    else:
        raise ValueError(f"unknown mode: {mode}")
    return rows.select(*columns, *([F.col("_metadata.file_name").alias(ROW_FILE)] if with_file else []))


def stamp(df: DataFrame, load_id: int | Column, load_datetime: datetime | Column, source_file: str | Column) -> DataFrame:
    """Add the load metadata; one instant per load, so that all its rows agree."""

    def literal(value):
        # A wall clock goes in as text, which no session time zone shifts.
        return value if isinstance(value, Column) else F.lit(str(value))

    return df.withColumns(
        {
            "load_id": literal(load_id).cast("bigint"),
            "load_datetime": literal(load_datetime).cast("timestamp_ntz"),
            "source_file": literal(source_file).cast("string"),
        }
    )
