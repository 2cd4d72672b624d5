"""What an operation yields: the new snapshot, the change set, counters and guards."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from functools import cache, cached_property
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import (
    SPARK_ERRORS,
    ConcurrencyMismatch,
    ConfigurationError,
    ConstraintError,
    ExecutionError,
    NotMatched,
    translated,
)
from rowtide.functions.enums import enum_label
from rowtide.operators.classify import DELETED, INSERTED, UPDATED, living
from rowtide.operators.constraints import unique_violations
from rowtide.operators.duplicates import duplicate_keys
from rowtide.operators.progress import reporting
from rowtide.plans.roles import ACTION, MERGE, ORDINAL
from rowtide.session import frozen, observed
from rowtide.sources.files import attempt, joined, read_text, write_text
from rowtide.sources.tables import Layout, write_rows, write_table

# Fixed value: the hidden file in a staged folder that holds its counters.
COUNTS = "_counts.json"


class Counts(NamedTuple):
    """Rows inserted, updated and deleted, and their sum."""

    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    total_affected: int = 0


@dataclass(frozen=True)
class Guards:
    """Conditions under which an operation must not be written."""

    no_mismatch: bool = False
    all_matched: bool = False
    count_source_rows: bool = False

    @property
    def active(self) -> bool:
        return self.no_mismatch or self.all_matched


@dataclass(frozen=True)
class ChangeResult:
    """The outcome of one operation. All frames are lazy, and so is the search for hot keys that some need.

    ``rows`` holds every row after the change with its ``action``; it is what a snapshot is written
    from. ``changed`` holds at least the changed ones. ``new_rows`` is set where the operation only
    adds rows; ``kept_rows`` and ``removed_rows`` where it only removes some.
    """

    kind: str
    find_rows: Callable[[], DataFrame]
    changes_of: Callable[[DataFrame], DataFrame]
    staged: DataFrame
    table_columns: tuple[str, ...]
    match: tuple[str, ...] = ()
    guards: Guards = field(default_factory=Guards)
    find_new: Callable[[], DataFrame] | None = None
    find_kept: Callable[[], DataFrame] | None = None
    find_removed: Callable[[], DataFrame] | None = None
    may_delete: bool = False
    at_risk: Mapping[tuple[str, ...], DataFrame | None] = field(default_factory=dict)
    elsewhere: DataFrame | None = None
    enriched: Callable[[DataFrame], DataFrame] | None = None
    find_unmatched: Callable[[DataFrame | None], DataFrame] | None = None
    find_stale: Callable[[], DataFrame] | None = None

    @cached_property
    def rows(self) -> DataFrame:
        """Every row after the change, the deleted ones too, with its ``action``."""
        return self.find_rows()

    @cached_property
    def new_rows(self) -> DataFrame | None:
        """The rows that an insert adds."""
        return self.find_new and self.find_new()

    @cached_property
    def kept_rows(self) -> DataFrame | None:
        return self.find_kept and self.find_kept()

    @cached_property
    def removed_rows(self) -> DataFrame | None:
        """The rows that a delete takes away."""
        return self.find_removed and self.find_removed()

    @property
    def changed(self) -> DataFrame:
        return self.rows if self.find_new is None else self.new_rows

    @property
    def snapshot(self) -> DataFrame:
        """The whole table after the operation."""
        kept = self.kept_rows
        if kept is None:
            kept = living(self.rows)
            kept = kept.where(_stays()) if self.may_delete else kept
        return kept.select(*self.table_columns)

    @property
    def changes(self) -> DataFrame:
        """One row per changed table row: ordinal of the source row, action, match and output columns."""
        return self.changes_of(self.changed)

    @property
    def counts(self) -> DataFrame:
        """One row of counters, read from the change set's ``action`` column alone."""
        return self.changes.agg(*tallies())

    @property
    def unmatched(self) -> DataFrame:
        """Source rows whose key is not in the target, in the columns the operation reads."""
        return self._unmatched_in(None)

    @property
    def stale(self) -> DataFrame:
        """Source rows whose key is in the target, but with another token."""
        if self.find_stale is None:
            raise ConfigurationError(f"{self.kind} does not compare its source rows this way")
        return self.find_stale()

    def _unmatched_in(self, table: DataFrame | None) -> DataFrame:
        if self.find_unmatched is None:
            raise ConfigurationError(f"{self.kind} does not compare its source rows this way")
        return self.find_unmatched(table)

    def freeze(self) -> ChangeResult:
        """The same outcome, computed once and kept on shared storage.

        Snapshot, change set and the rows added or removed otherwise run the join each; freezing pays where several
        are wanted, or where the source would not read the same twice.
        """
        if self.find_new is not None:
            added = frozen(self.new_rows)
            return replace(self, find_rows=once(lambda: frozen(self.rows)), find_new=lambda: added)
        rows = frozen(self.rows)
        taken = rows.where(F.col(ACTION) == DELETED).select(*self.table_columns)
        removed = None if self.find_removed is None else lambda: taken
        return replace(self, find_rows=lambda: rows, find_kept=None, find_removed=removed)

    def write_back(self) -> DataFrame:
        """The source rows with the output columns filled from the rows they changed."""
        if self.enriched is None:
            raise ConfigurationError("the operation returns nothing to its source rows")
        return self.enriched(self.changes)

    def check(self) -> Counts:
        """Count the changes and raise if a guard or a unique key is violated. Writes nothing."""
        with as_change_errors():
            counts = Counts(*self.counts.first())
            self.require_guards(counts)
            self.require_unique(self.snapshot)
        return counts

    def save(
        self,
        path: str,
        layout: Layout | None = None,
        progress: Callable[[int], None] | None = None,
    ) -> Counts:
        """Write the snapshot to a new folder, check guards and unique keys against it, then let it be seen.

        The table is read by the one job that writes; what is checked afterwards is read from the hidden folder of the
        attempt, which goes if a rule is broken.
        """
        spark = self.staged.sparkSession
        with as_change_errors(), attempt(spark, path) as folder:
            counts = self.stage(folder, layout or Layout(), progress)
            keep_counts(spark, folder, counts)
        return counts

    def stage(self, folder: str, layout: Layout, progress: Callable[[int], None] | None = None) -> Counts:
        """Write the snapshot to ``folder`` and check it there.

        The counters are taken as the rows reach the files, so that only the successful attempt of each final task
        counts, in whatever layout.
        """
        spark = self.staged.sparkSession
        rows = self.rows.select(*self.table_columns, ACTION)
        seen = Observation()
        with reporting(spark, progress) as report:
            passing = layout.arranged(rows).observe(seen, *tallies(), _kept().alias("kept"))
            kept = passing.where(_stays()) if self.may_delete else passing
            write_rows(kept.select(*layout.stored_columns(self.table_columns)), folder, layout, mode="errorifexists")
            tallied = observed(seen)
            report(tallied.pop("kept", 0))
        counts = Counts(**tallied)
        written = spark.read.schema(layout.stored_schema(rows.drop(ACTION).schema)).parquet(folder).select(*self.table_columns)
        self.require_guards(counts, written)
        self.require_unique(written)
        return counts

    def save_table(
        self, name: str, buckets: int, layout: Layout | None = None, progress: Callable[[int], None] | None = None
    ) -> Counts:
        """Write the snapshot as a new catalog table in hash buckets of the match columns.

        It is written and checked under another name and then renamed.
        """
        spark = self.staged.sparkSession
        draft = f"{name.replace('`', '')}_{uuid.uuid4().hex}"
        with as_change_errors():
            if spark.catalog.tableExists(name):
                raise ExecutionError(f"table {name} exists already")
            seen = Observation()
            rows = self.rows.select(*self.table_columns, ACTION).repartition(buckets, *self.match)
            try:
                with reporting(spark, progress) as report:
                    kept = rows.observe(seen, *tallies(), _kept().alias("kept")).where(_stays())
                    write_table(kept.select(*self.table_columns), draft, self.match, buckets, layout or Layout())
                    tallied = observed(seen)
                    report(tallied.pop("kept", 0))
                counts = Counts(**tallied)
                written = spark.table(draft)
                self.require_guards(counts, written)
                self.require_unique(written)
                spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
            except BaseException:
                spark.sql(f"DROP TABLE IF EXISTS {draft}")
                raise
        return counts

    def append_to(
        self, path: str, layout: Layout | None = None, progress: Callable[[int], None] | None = None
    ) -> Counts:
        """Add the new rows to an existing folder without rewriting it. Inserts only."""
        return self._append(lambda rows: write_rows(rows, path, layout or Layout(), mode="append"), progress)

    def append_to_table(self, name: str, progress: Callable[[int], None] | None = None) -> Counts:
        """Add the new rows to a catalog table without rewriting it. Inserts only."""
        return self._append(lambda rows: rows.write.insertInto(name), progress)

    def _append(self, write: Callable[[DataFrame], None], progress: Callable[[int], None] | None) -> Counts:
        if self.find_new is None:
            raise ConfigurationError(f"{self.kind} changes existing rows and cannot be appended")
        with as_change_errors(), reporting(self.staged.sparkSession, progress) as report:
            self.require_unique(self.snapshot)
            seen = Observation()
            write(self.new_rows.observe(seen, *tallies()).select(*self.table_columns))
            counts = Counts(**observed(seen))
            report(counts.inserted)
        return counts

    def require_guards(self, counts: Counts, written: DataFrame | None = None) -> None:
        """Raise unless as many rows applied as the guards ask for.

        ``written`` is the finished snapshot, whose keys are then compared instead of the table's; no operation with
        this guard changes a row's match columns.
        """
        if not self.guards.active:
            return
        expected = self.staged.count()
        applied = counts.inserted + counts.updated if self.kind == MERGE else counts.total_affected
        if self.guards.no_mismatch and applied < expected:
            raise ConcurrencyMismatch(expected, applied)
        if self.guards.all_matched:
            reached = counts.total_affected
            if self.guards.count_source_rows:
                reached = expected - self._unmatched_in(written).count()
            if reached < expected:
                raise NotMatched(expected, reached)

    def require_unique(self, snapshot: DataFrame) -> None:
        """Raise if a value that the operation brought in occurs twice in a unique group of ``snapshot``."""
        whole = snapshot if self.elsewhere is None else snapshot.unionByName(self.elsewhere)
        for group, new_values in self.at_risk.items():
            if new_values is None:
                # The table made these values itself: repeats first, and only if there are any, whose they are.
                if duplicate_keys(whole, group).isEmpty():
                    continue
                new_values = self.rows.where(F.col(ACTION).isin(INSERTED, UPDATED))
            found = unique_violations(whole, new_values, group).first()
            if found is not None:
                values = ", ".join(f"{name}={found[name]}" for name in group)
                raise ConstraintError(f"{values} occurs {found['copies']} times")


def keep_counts(spark: SparkSession, folder: str, counts: Counts) -> None:
    """Mark a staged result as complete, and keep its counters with it."""
    write_text(spark, joined(folder, COUNTS), json.dumps(counts._asdict()))


def stored_counts(spark: SparkSession, folder: str) -> Counts | None:
    """The counters of a staged result; ``None`` if it is not complete."""
    text = read_text(spark, joined(folder, COUNTS))
    return None if text is None else Counts(**json.loads(text))


@contextmanager
def as_change_errors() -> Iterator[None]:
    """Errors of Spark as errors of this package."""
    try:
        yield
    except SPARK_ERRORS as error:
        raise translated(error) from error


def once(find: Callable[[], DataFrame]) -> Callable[[], DataFrame]:
    """``find``, called when first needed, its errors translated, its answer kept."""

    def found() -> DataFrame:
        with as_change_errors():
            return find()

    return cache(found)


def _answers(changes: DataFrame, output: Sequence[str], one_change_per_source_row: bool) -> DataFrame:
    """One row of output values per source row that changed something.

    A source row may change many target rows; it then gets the largest of their value tuples, which
    is combined before the shuffle.
    """
    applied = changes.where(F.col(ORDINAL).isNotNull() & (F.col(ACTION) != DELETED))
    values = applied.select(F.col(ORDINAL).alias("__of"), *(F.col(n).alias(f"__out_{n}") for n in output))
    if one_change_per_source_row or not output:
        return values
    names = values.columns[1:]
    best = values.groupBy("__of").agg(F.max(F.struct(*names)).alias("best"))
    return best.select("__of", *(F.col(f"best.{n}").alias(n) for n in names))


def enriched_source(
    source: DataFrame,
    changes: DataFrame,
    output: Sequence[str],
    mapping: Mapping[str, str],
    enums: Mapping[str, Mapping[str, int]],
    one_change_per_source_row: bool,
) -> DataFrame:
    """``source`` with ``output`` values where a change happened; other rows stay as they are.

    An enum column that the source holds as labels gets labels back.
    """
    values = _answers(changes, output, one_change_per_source_row)
    values = values.withColumn("__applied", F.lit(True))
    joined = source.join(values, F.col(ORDINAL) == F.col("__of"), "left")
    called = {theirs: mine for mine, theirs in mapping.items()}
    filled: dict[str, Column] = {}
    for name in output:
        own = called.get(name, name)
        after, before = F.col(f"__out_{name}"), F.lit(None)
        if own in source.columns:
            before = F.col(own)
            if name in enums and isinstance(source.schema[own].dataType, T.StringType):
                after = enum_label(after, enums[name])
        filled[own] = F.when(F.col("__applied"), after).otherwise(before)
    columns = [filled.pop(name).alias(name) if name in filled else F.col(name) for name in source.columns]
    return joined.select(*columns, *(value.alias(name) for name, value in filled.items()))


def _stays() -> Column:
    return ~F.col(ACTION).eqNullSafe(DELETED)


def _kept() -> Column:
    return F.count_if(_stays())


def tallies() -> tuple[Column, ...]:
    """The counters, over rows with an ``action``."""

    def of(action: str) -> Column:
        return F.count_if(F.col(ACTION) == action)

    return (
        of(INSERTED).alias("inserted"),
        of(UPDATED).alias("updated"),
        of(DELETED).alias("deleted"),
        F.count(ACTION).alias("total_affected"),
    )
