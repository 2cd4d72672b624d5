"""The number of rows written, reported while a write runs."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

SECONDS = 0.1


@contextmanager
def reporting(spark: SparkSession, callback: Callable[[int], None] | None) -> Iterator[Callable[[int], None]]:
    """Call back with the running number of rows written by the jobs that the block starts.

    Spark counts the rows of a task when the task ends, so the number rises task by task; it never falls. The block
    calls what it is given with the exact number, once that is known. Without a callback nothing is watched.
    """
    if callback is None:
        yield lambda rows: None
        return
    context = spark.sparkContext
    tag = f"rowtide-{uuid.uuid4().hex}"
    done, reported = threading.Event(), [0]

    def report(rows: int) -> None:
        if rows > reported[0]:
            reported[0] = rows
            callback(rows)

    def watch() -> None:
        while not done.wait(SECONDS):
            report(_written(context, tag))

    watcher = threading.Thread(target=watch, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield lambda rows: (done.set(), watcher.join(), report(rows))
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)


def _written(context, tag: str) -> int:
    """Rows in files of the tagged jobs' ended tasks."""
    scala = context._jsc.sc()
    store = scala.statusStore()
    tracker, rows = scala.statusTracker(), 0
    for job in tracker.getJobIdsForTag(tag):
        info = tracker.getJobInfo(job)
        for stage in info.get().stageIds() if info.isDefined() else ():
            try:
                rows += store.lastStageAttempt(stage).outputRecords()
            except Py4JError:  # it has not started yet, or is forgotten
                continue
    return rows
