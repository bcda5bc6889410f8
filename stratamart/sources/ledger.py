"""Load control: batch ledger, run log and the commit records of every stored table.

The three control tables are append-only Parquet. A row is never changed; the latest row of a
batch, run or table is its state. Rows are numbered within their pipeline, and the number is the
only order: clocks of different machines are not compared. A number can be written once, so a second
writer that did not see the last row fails. The tables grow with the number of loads, not with the data.

Each row is a folder of its own, so a table is opened from a snapshot: before a row is added, all rows up to the
last one are put into one file if there are SNAPSHOT_EVERY of them behind the last snapshot. A reader takes the newest
snapshot and asks for the numbers after it, one by one, as they have no gaps. A snapshot that is lost is only a
longer way from the one before it, and the next row brings a new one.
"""

from __future__ import annotations

import json
import time
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.operators.latest import latest
from stratamart.schemas import BATCH_CONTROL, LONG, PIPELINE_CONTROL, RUN_LOG
from stratamart.sources.files import children, has_rows

SEQ = "seq"
SNAPSHOT_EVERY = 16
# The status words of the control tables.
RUNNING, SUCCESS, FAILED = "Running", "Success", "Failed"
NO_NEW_DATA = "Success - No New Data"


class BatchAlreadyLoaded(RuntimeError):
    """The batch key was loaded successfully before."""


class BatchRunning(RuntimeError):
    """The batch key is marked as being loaded."""


class ConcurrentLoad(RuntimeError):
    """Another job wrote the next control row of the pipeline."""


def now() -> datetime:
    """Wall clock in UTC without a zone, as stored."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class Run:
    """Counts of one run; written to the run log when the run ends."""

    run_id: int
    pipeline: str
    rows_extracted: int = 0
    rows_updated: int = 0
    rows_inserted: int = 0
    rows_check: int = 0
    rows_rejected: int = 0
    status: str = SUCCESS

    @property
    def rows_loaded(self) -> int:
        return self.rows_updated + self.rows_inserted

    def summary(self) -> dict:
        return {
            "run_id": self.run_id,
            "rows_extracted": self.rows_extracted,
            "rows_updated": self.rows_updated,
            "rows_inserted": self.rows_inserted,
            "rows_loaded": self.rows_loaded,
            "rows_check": self.rows_check,
            "rows_rejected": self.rows_rejected,
            "status": self.status,
        }


def _literal(value) -> Column:
    """A literal; a wall clock goes in as text, which no session time zone shifts."""
    return F.lit(str(value) if isinstance(value, datetime) else value)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


class Ledger:
    """Reads and appends control rows below ``root``, in one folder per table and pipeline.

    A load reads the rows of its own pipeline only. Loads of different pipelines may run side
    by side; one pipeline has one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: dict[str, list[Row]] = {}
        self._covered: dict[str, int] = {}  # by the newest snapshot seen

    # -- storage -------------------------------------------------------------------------------

    def append(self, name: str, schema: T.StructType, **values) -> None:
        """One row under the number after the last one that this ledger has seen of the table."""
        row = [_literal(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
        if name not in self._known:
            self._history(name, schema)
        last = self._last(name)
        if last - self._covered.get(name, 0) >= SNAPSHOT_EVERY:
            self._snapshot(name, schema, last)
        try:
            self.spark.range(1, numPartitions=1).select(*row).write.parquet(self._place(name, last + 1))
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            del self._known[name]
            raise ConcurrentLoad(f"{name}: row {last + 1} was written by another job") from error
        self._known[name].append(Row(**{f.name: values.get(f.name) for f in schema.fields}, **{SEQ: last + 1}))

    def _last(self, name: str) -> int:
        return self._known[name][-1][SEQ] if self._known[name] else 0

    def _place(self, name: str, seq: int) -> str:
        return f"{self.root}/{name}/{SEQ}={seq}"

    def _snapshots(self, name: str) -> str:
        return f"{self.root}/snapshots/{name}"

    def parts(self, name: str) -> tuple[int, list[int]]:
        """The last number in the newest snapshot, 0 without one, and the numbers of the rows after it."""
        numbers = sorted((int(x.removeprefix("upto=")) for x in children(self.spark, self._snapshots(name))), reverse=True)
        upto = next((n for n in numbers if has_rows(self.spark, f"{self._snapshots(name)}/upto={n}")), 0)
        return upto, self._after(name, upto)

    def _after(self, name: str, seq: int) -> list[int]:
        found = []
        while has_rows(self.spark, self._place(name, seq + 1)):
            found.append(seq := seq + 1)
        return found

    def _snapshot(self, name: str, schema: T.StructType, last: int) -> None:
        """Put all rows up to the last one into one file, unless another job has just done so."""
        self._covered[name] = self.parts(name)[0]
        if last - self._covered[name] < SNAPSHOT_EVERY:
            return
        rows = self.events(name, schema).where(F.col(SEQ) <= last)
        try:
            rows.coalesce(1).sortWithinPartitions(SEQ).write.parquet(f"{self._snapshots(name)}/upto={last}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        self._covered[name] = last

    def events(self, name: str, schema: T.StructType) -> DataFrame:
        """All rows of a control table, of one pipeline or of all: the newest snapshots and the rows after them."""
        below = children(self.spark, f"{self.root}/{name}")
        names = [name] if any(x.startswith(f"{SEQ}=") for x in below) else [f"{name}/{x}" for x in below if "=" in x]
        found = {x: self.parts(x) for x in names}
        snapshots = [f"{self._snapshots(x)}/upto={upto}" for x, (upto, _) in found.items() if upto]
        rows = [self._place(x, seq) for x, (_, tail) in found.items() for seq in tail]
        return self._read(name, schema, snapshots, rows)

    def _read(self, name: str, schema: T.StructType, snapshots: list[str], rows: list[str]) -> DataFrame:
        numbered = T.StructType(schema.fields + [T.StructField(SEQ, LONG)])
        reader, columns = self.spark.read.schema(numbered), numbered.fieldNames()
        parts = [reader.parquet(*snapshots).select(*columns)] if snapshots else []
        parts += [reader.option("basePath", f"{self.root}/{name}").parquet(*rows).select(*columns)] if rows else []
        if not parts:
            return no_rows(self.spark, numbered)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _history(self, name: str, schema: T.StructType) -> list[Row]:
        """All rows of a control table by number; what this ledger has seen before isn't read again."""
        known = self._known.get(name)
        if known is None:
            self._covered[name], tail = upto, tail = self.parts(name)
            snapshots = [f"{self._snapshots(name)}/upto={upto}"] if upto else []
        else:
            snapshots, tail = [], self._after(name, self._last(name))
        new = []
        if snapshots or tail:
            new = self._read(name, schema, snapshots, [self._place(name, seq) for seq in tail]).collect()
        self._known[name] = (known or []) + sorted(new, key=lambda row: row[SEQ])
        return list(self._known[name])

    # -- batches -------------------------------------------------------------------------------

    def batches(self) -> DataFrame:
        """Current state of every batch."""
        events = self.events("batch_control", BATCH_CONTROL)
        return latest(events, ["pipeline_name", "batch_id"], [F.col(SEQ).desc()]).drop(SEQ)

    def start_batch(self, pipeline: str, batch_key: str, source_name: str, takeover: bool = False) -> Row:
        """Open a batch, or refuse it without touching the ledger.

        Batch ids count up within a pipeline. A failed key is retried under a new one; its rows
        then carry a load id of their own, so leftovers of the failed attempt are never read. With ``takeover`` an attempt
        that is still marked as running is closed as failed first.
        """
        state = {row.batch_id: row for row in self._history(f"batch_control/pipeline={pipeline}", BATCH_CONTROL)}
        attempts = [r for r in state.values() if r.source_batch_key == batch_key]
        if any(r.status == SUCCESS for r in attempts):
            raise BatchAlreadyLoaded(f"{pipeline}: batch {batch_key} has already been loaded successfully")
        for running in (r for r in attempts if r.status == RUNNING):
            if not takeover:
                raise BatchRunning(f"{pipeline}: batch {batch_key} is already running")
            self.end_batch(running, FAILED, 0)
        batch = Row(
            batch_id=max(state, default=0) + 1,
            pipeline_name=pipeline,
            source_name=source_name,
            source_batch_key=batch_key,
            batch_start_time=now(),
        )
        self.append(f"batch_control/pipeline={pipeline}", BATCH_CONTROL, status=RUNNING, **batch.asDict())
        return batch

    def end_batch(self, batch: Row, status: str, rows_loaded: int) -> None:
        self.append(
            f"batch_control/pipeline={batch.pipeline_name}",
            BATCH_CONTROL,
            status=status,
            batch_end_time=now(),
            rows_loaded=rows_loaded,
            **{
                name: batch[name]
                for name in ("batch_id", "pipeline_name", "source_name", "source_batch_key", "batch_start_time")
            },
        )

    def loaded_batches(self, pipeline: str) -> dict[int, int]:
        """Rows of each successful batch of one pipeline: the only loads readers may see."""
        return {
            row.batch_id: row.rows_loaded
            for row in self._history(f"batch_control/pipeline={pipeline}", BATCH_CONTROL)
            if row.status == SUCCESS
        }

    # -- runs ----------------------------------------------------------------------------------

    def runs(self) -> DataFrame:
        """Current state of every run; `seq` orders the runs of one pipeline."""
        events = self.events("run_log", RUN_LOG)
        return latest(events, ["run_id"], [F.col(SEQ).desc()])

    @contextmanager
    def run(self, pipeline: str):
        """Log a run as Running, then as Success or Failed with its counts; errors pass through."""
        started = now()
        # The clock in nanoseconds names folders and log rows; nothing is ordered by it.
        run = Run(time.time_ns(), pipeline)
        self.append(
            f"run_log/pipeline={pipeline}",
            RUN_LOG,
            run_id=run.run_id,
            pipeline_name=pipeline,
            status=RUNNING,
            start_time=started,
        )

        def finish(status: str, message: str | None = None) -> None:
            self.append(
                f"run_log/pipeline={pipeline}",
                RUN_LOG,
                run_id=run.run_id,
                pipeline_name=pipeline,
                status=status,
                start_time=started,
                end_time=now(),
                rows_extracted=run.rows_extracted,
                rows_loaded=run.rows_loaded,
                rows_rejected=run.rows_rejected,
                error_message=message,
            )

        try:
            yield run
        except BaseException as error:
            run.status = FAILED
            finish(FAILED, str(error))
            raise
        finish(SUCCESS)

    # -- commits -------------------------------------------------------------------------------

    def commits(self, pipeline: str) -> list[Row]:
        """Commit records of one table, oldest first."""
        return self._history(f"pipeline_control/pipeline={pipeline}", PIPELINE_CONTROL)

    def commit(
        self,
        pipeline: str,
        version: int | None,
        load_ids: list[int],
        watermark: int,
        whole: bool = False,
        seen: dict[str, int] | None = None,
    ) -> None:
        """Publish a written version and move the watermark, in one record.

        ``whole`` says that the version holds all current rows, so readers start from it. ``seen`` has the
        number of the last commit that the load knew of each of its source tables.

        Written last: a job that dies before this line leaves files nobody reads, and running
        it again gives the same table.
        """
        self.append(
            f"pipeline_control/pipeline={pipeline}",
            PIPELINE_CONTROL,
            pipeline_name=pipeline,
            watermark_value=str(watermark),
            last_successful_run=now(),
            is_active=1,
            version=version,
            load_ids=load_ids,
            whole=whole,
            seen=json.dumps(seen or {}, sort_keys=True),
        )

    def pipelines(self) -> DataFrame:
        """Current watermark and last successful run of every pipeline."""
        events = self.events("pipeline_control", PIPELINE_CONTROL)
        current = latest(events, ["pipeline_name"], [F.col(SEQ).desc()])
        return current.select("pipeline_name", "watermark_value", "last_successful_run", "is_active")
