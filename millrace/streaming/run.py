"""Stream runners.

Offsets are committed to the checkpoint after a batch function has returned,
so a batch may run again after a failure: its writes must be idempotent.  A
batch function is not called when there is no new input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

BatchFunction = Callable[[DataFrame, int], None]


def run_available(stream: DataFrame, batch: BatchFunction, checkpoint: str) -> StreamingQuery:
    """Process what is there now, then stop.  Errors are raised here."""
    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_every(stream: DataFrame, batch: BatchFunction, checkpoint: str, interval: str = "1 second") -> StreamingQuery:
    """Start micro-batches at an interval; the caller awaits or stops them."""
    return (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )


def append_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append available rows to Parquet files, each exactly once, then stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def split_batch(rejected: Callable[[DataFrame], DataFrame], accepted: BatchFunction, quarantine: str) -> BatchFunction:
    """Batch function that sets bad rows aside and passes the batch on.

    Rejects of a batch are written to a folder of its own, replaced on replay.
    The batch is read from its source once.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        held = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected(held).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
            accepted(held, batch_id)
        finally:
            held.unpersist()

    return handle
