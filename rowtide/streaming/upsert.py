"""A stream of changes applied to a table, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.operation import Operation
from rowtide.sources.files import joined, remove
from rowtide.sources.partitions import FolderTable


def apply_stream(
    stream: DataFrame,
    table: FolderTable,
    operation: Callable[[DataFrame], Operation],
    checkpoint: str,
    staging: str,
    progress: Callable[[int], None] | None = None,
    changes: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Start a query that carries out ``operation(batch)`` on ``table`` for every micro-batch.

    Spark may deliver a batch again after a failure. Each batch is staged under its own number, so
    the second delivery finds a finished result or computes it from an unchanged table; that makes
    updates, deletes and merges by key take effect once. ``progress`` receives the running number
    of source rows. Under ``changes`` every batch leaves its change set, in a folder ``batch=<number>`` that a second
    delivery does not write again.
    """
    seen = 0

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal seen
        # Several jobs read the batch; the source files are then scanned once.
        batch.persist()
        try:
            told = None if changes is None else joined(changes, f"batch={batch_id}")
            table.apply(operation(batch), joined(staging, f"batch={batch_id}"), changes=told)
            # The batch before this one is committed and will not be delivered again.
            remove(batch.sparkSession, joined(staging, f"batch={batch_id - 1}"))
            if progress is not None:
                seen += batch.count()
                progress(seen)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
