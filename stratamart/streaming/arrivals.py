"""Load files as they arrive: the stream's checkpoint remembers which files were taken.

Every micro-batch goes through the ordinary bronze and silver loads, so a stream and a batch
load give the same tables. The epoch number is the batch key: an epoch that is replayed after
a failure is either found in the ledger and skipped, or taken over and loaded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from stratamart.plans.warehouse import Warehouse
from stratamart.schemas import SILVER
from stratamart.sources.ledger import BatchAlreadyLoaded
from stratamart.sources.raw import read_raw


def load_arrivals(
    warehouse: Warehouse, table: str, folder: str, checkpoint: str, mode: str = "quoted", files_per_batch: int = 1000
) -> StreamingQuery:
    """Load what is in ``folder`` and not yet loaded, then stop; call again for later files."""
    stream = read_raw(warehouse.spark, table, folder, mode, stream=True, files_per_batch=files_per_batch)

    def load(rows: DataFrame, epoch: int) -> None:
        if rows.isEmpty():
            return
        try:
            warehouse.load_bronze_rows(table, rows, f"{checkpoint}#{epoch}", folder, takeover=True)
        except BatchAlreadyLoaded:
            pass
        if table in SILVER:
            warehouse.load_silver(table)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
