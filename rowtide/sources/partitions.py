"""Snapshots in folders by column value, of which a change rewrites only those it touches."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.operation import Insert, Merge, Operation
from rowtide.operators.outcome import ChangeResult, Counts, as_change_errors, keep_counts, stored_counts
from rowtide.sources.files import exists, joined, listed, move, read_text, remove, write_text
from rowtide.sources.tables import Layout, subfolders, write_rows

# Fixed value: the hidden file in a staged folder that says which folders it replaces.
TOUCHED = "_touched.json"

_FILE = "__file"


class FolderTable:
    """A Parquet folder whose subfolders are named by columns.

    An operation reads and rewrites only the subfolders that hold a row it may change; the others keep their files.
    The result goes to a staging folder, is checked there, and its subfolders are then moved into place, a step that
    can be repeated after any failure with the same end. Readers should wait for it: each subfolder changes at once,
    but one after another.
    """

    path: str
    schema: T.StructType

    @property
    def layout(self) -> Layout:
        raise NotImplementedError

    def read(self, spark: SparkSession) -> DataFrame:
        """The whole table."""
        return self._stored(spark).select(*self.schema.names)

    def create(self, rows: DataFrame) -> None:
        """Write the first snapshot."""
        arranged = self.layout.arranged(rows.select(*self.schema.names))
        write_rows(arranged, self.path, self.layout, mode="errorifexists")

    def apply(
        self, operation: Operation, staging: str, progress: Callable[[int], None] | None = None,
        changes: str | None = None,
    ) -> Counts:
        """Carry out ``operation`` on the touched subfolders and put them in place.

        ``staging`` names the attempt: if it already holds a complete result, as after a failure in the second step,
        that result is put in place, nothing is computed, and the counters are those of the first time. With
        ``changes`` the change set goes to that folder, once, before anything else can be seen.
        """
        spark = operation.source.sparkSession
        with as_change_errors():
            self._require(operation, spark)
            counts = stored_counts(spark, staging)
            if counts is None:
                remove(spark, staging)
                counts = self._staged(operation, spark, staging, progress, changes)
                if counts is None:
                    return Counts()
            self._publish(spark, staging)
        return counts

    def _staged(self, operation: Operation, spark: SparkSession, staging: str, progress, changes) -> Counts | None:
        """Write and check what the touched subfolders hold afterwards; nothing if the source is empty."""
        found = self._reached(operation, spark)
        if found is None:
            return None
        touched, inside = found
        stored = self._stored(spark)
        if isinstance(operation, Insert) and not touched:
            whole = stored.select(*self.schema.names)
            result = operation.on(whole).plan()
            result = replace(result, find_rows=result.find_new, elsewhere=whole)
        else:
            target, elsewhere = (stored.where(which).select(*self.schema.names) for which in (inside, ~inside))
            result = operation.on(target, elsewhere).plan()
        layout = operation.laid_out(result.match, self.layout)
        if changes is not None:
            result = result.freeze()
        counts = result.stage(staging, layout, progress or operation.on_progress)
        if changes is not None:
            self._tell(spark, result, changes)
        filled = subfolders(spark, staging, len(layout.folders))
        write_text(spark, joined(staging, TOUCHED), json.dumps({"touched": sorted(touched), "filled": filled}))
        keep_counts(spark, staging, counts)
        return counts

    def _tell(self, spark: SparkSession, result: ChangeResult, changes: str) -> None:
        remove(spark, changes)  # of an attempt that did not end
        result.changes.write.parquet(changes)

    def _publish(self, spark: SparkSession, staging: str) -> None:
        """Move the staged subfolders into place: those of touched ones replace them, others add their files."""
        said = json.loads(read_text(spark, joined(staging, TOUCHED)))
        filled, touched = set(said["filled"]), set(said["touched"])
        for name in sorted(filled | touched):
            staged, place = joined(staging, name), joined(self.path, name)
            if name not in filled:
                remove(spark, place)
            elif not exists(spark, staged):
                continue  # moved by an earlier attempt
            elif name in touched or not exists(spark, place):
                remove(spark, place)
                move(spark, staged, place)
            else:
                for file in listed(spark, staged):
                    move(spark, joined(staged, file), joined(place, file))
                remove(spark, staged)

    def _stored(self, spark: SparkSession) -> DataFrame:
        typed = self.layout.stored_schema(self.schema)
        if not exists(spark, self.path):
            return spark.createDataFrame([], typed)
        return spark.read.schema(typed).parquet(self.path)

    def _require(self, operation: Operation, spark: SparkSession) -> None:
        """Check the description against the table, also where there is nothing to do."""
        operation.on(self.read(spark)).validate()

    def _reached(self, operation: Operation, spark: SparkSession) -> tuple[set[str], Column] | None:
        """The subfolders that hold rows the operation may change, and the condition for a row to lie in one."""
        raise NotImplementedError


@dataclass(frozen=True)
class PartitionedTable(FolderTable):
    """A folder partitioned by columns of the table, whatever its key is.

    The rows that the source may change are looked up by their match columns first, which reads these columns of all
    partitions. A changed row may move to another partition; its old one is rewritten without it. Partitions that only
    gain rows are not read again: they get a file more.
    """

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...]

    @property
    def layout(self) -> Layout:
        return Layout(partition_by=self.partition_by)

    def _reached(self, operation: Operation, spark: SparkSession) -> tuple[set[str], Column] | None:
        if operation.source.isEmpty():
            return None
        if isinstance(operation, Insert) or not exists(spark, self.path):
            return set(), F.lit(False)
        named = F.to_json(F.struct(*self.partition_by), {"ignoreNullFields": "false"})
        stored = self._stored(spark).withColumn(_FILE, F.col("_metadata.file_path"))
        mirrors = isinstance(operation, Merge) and operation.mirror
        met = stored if mirrors else operation.located(stored)
        folder = F.regexp_replace(_FILE, "/[^/]*$", "").alias(_FILE)
        # No more rows than the table has partitions.
        homes = met.select(named.alias("named"), folder).distinct().collect()
        depth = len(self.partition_by)
        touched = {"/".join(unquote(row[_FILE]).split("/")[-depth:]) for row in homes}
        labels = sorted({row["named"] for row in homes})
        return touched, named.isin(labels) if labels else F.lit(False)
