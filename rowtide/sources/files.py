"""Folders and small files wherever Spark keeps its tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from rowtide.errors import ExecutionError


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def joined(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _at(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    store, place = _at(spark, path)
    store.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or a folder; ``to`` must not exist, its parent need not."""
    store, place = _at(spark, path)
    _, goal = _at(spark, to)
    if store.exists(goal):
        raise ExecutionError(f"{to} exists already")
    if goal.getParent() is not None:
        store.mkdirs(goal.getParent())
    if not store.rename(place, goal):
        raise ExecutionError(f"cannot move {path} to {to}")


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, hidden ones left out."""
    store, place = _at(spark, path)
    names = [status.getPath().getName() for status in store.listStatus(place)]
    return sorted(name for name in names if name[0] not in "._" or "=" in name)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it appears whole or not at all."""
    draft = f"{path}.{uuid.uuid4().hex}"
    store, place = _at(spark, draft)
    out = store.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    remove(spark, path)
    move(spark, draft, path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; ``None`` if there is none."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def attempt(spark: SparkSession, path: str) -> Iterator[str]:
    """A hidden folder next to ``path``, which becomes ``path`` in one step when the block ends.

    If the block fails, the folder goes and ``path`` never was. The last step is a rename: atomic on file
    systems; a store that copies instead should have ``path`` read only after the call returned.
    """
    if exists(spark, path):
        raise ExecutionError(f"{path} exists already")
    head, _, name = path.rstrip("/").rpartition("/")
    folder = f"{head}/_{name}.{uuid.uuid4().hex}" if head else f"_{name}.{uuid.uuid4().hex}"
    try:
        yield folder
        move(spark, folder, path)
    except BaseException:
        remove(spark, folder)
        raise
