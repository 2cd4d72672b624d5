"""Several operations as one unit: each works on the snapshot the one before it yields."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rowtide.operators.classify import CODES, living
from rowtide.operators.operation import Operation
from rowtide.operators.outcome import ChangeResult, Counts, as_change_errors, keep_counts
from rowtide.operators.progress import reporting
from rowtide.plans.roles import ACTION, ORDINAL, PAST
from rowtide.session import frozen, observed
from rowtide.sources.files import attempt
from rowtide.sources.tables import Layout, laid_out_as, point_to, qualified, write_rows
from rowtide.spec import TableSpec


class Chain:
    """Operations applied in order to one table, written once and only if all of them pass.

    A step is an operation, or a function from the steps so far to an operation (for one that needs
    an earlier step's output). The steps stay lazy and make one plan, with one join a step: every row carries along what
    each step did to it, deleted rows too, and the counters of all steps are taken from that where the rows reach the
    files. ``freeze`` stores the state between two steps on shared storage, for a step that reads the table more
    than once (to make ids, or in a split merge).
    """

    def __init__(self, target: DataFrame):
        self._target = target
        self._table = target
        self.results: list[ChangeResult] = []

    def then(self, step: Operation | Callable[[Sequence[ChangeResult]], Operation]) -> Chain:
        operation = step(self.results) if callable(step) else step
        result = operation.on(self._table).plan()
        done = len(self.results)
        self.results.append(result)
        self._table = _remembering(result.rows, done)
        return self

    def freeze(self) -> Chain:
        self._table = frozen(self._table)
        return self

    @property
    def snapshot(self) -> DataFrame:
        """The table after the last step."""
        return living(self._table).select(*self._columns)

    @property
    def _columns(self) -> tuple[str, ...]:
        return self.results[-1].table_columns if self.results else tuple(self._target.columns)

    def check(self) -> list[Counts]:
        """The counters of every step, from one job; raises on the first guard that is violated."""
        if not self.results:
            return []
        with as_change_errors():
            counts = self._counts(self._table.agg(*self._tallies()).first().asDict())
            self._require(counts)
        return counts

    def save(
        self, path: str, layout: Layout | None = None, progress: Callable[[int], None] | None = None
    ) -> list[Counts]:
        """Write the final snapshot to a new folder, check every step, then let the folder be seen."""
        spark, layout = self._target.sparkSession, layout or Layout()
        with as_change_errors(), attempt(spark, path) as folder, reporting(spark, progress) as report:
            if not self.results:
                write_rows(layout.arranged(self._target), folder, layout, mode="errorifexists")
                return []
            seen = Observation()
            passing = layout.arranged(self._table).observe(seen, *self._tallies())
            kept = living(passing).select(*layout.stored_columns(self._columns))
            write_rows(kept, folder, layout, mode="errorifexists")
            tallied = observed(seen)
            report(tallied.get("kept", 0))
            counts = self._counts(tallied)
            self._require(counts)
            keep_counts(spark, folder, Counts(*(sum(column) for column in zip(*counts))))
        return counts

    def commit(self, spec: TableSpec, path: str, table: str | None = None, schema: str | None = None) -> list[Counts]:
        """Save to a new folder, then let the catalog table point there: all steps take effect at once."""
        spark, name = self._target.sparkSession, qualified(spec, table, schema)
        counts = self.save(path, laid_out_as(spark, name, Layout()))
        point_to(spark, name, path)
        return counts

    def _tallies(self) -> list[Column]:
        """How many rows each step inserted, updated and deleted, and how many are left."""
        found = [F.count_if(F.coalesce(~F.col(PAST).contains(CODES["DELETE"]), F.lit(True))).alias("kept")]
        for n in range(len(self.results)):
            at = F.substring(PAST, n + 1, 1)
            found += [F.count_if(at == code).alias(f"{code}{n}") for code in CODES.values()]
        return found

    def _counts(self, tallied: dict[str, int]) -> list[Counts]:
        counts = []
        for n in range(len(self.results)):
            done = [tallied.get(f"{code}{n}", 0) for code in CODES.values()]
            counts.append(Counts(*done, sum(done)))
        return counts

    def _require(self, counts: list[Counts]) -> None:
        for result, count in zip(self.results, counts):
            result.require_guards(count)
            if result.at_risk:
                result.require_unique(result.snapshot)


def _remembering(rows: DataFrame, done: int) -> DataFrame:
    """``rows`` with what the step after ``done`` others did to each in ``PAST``."""
    before = F.lit("-" * done)
    if PAST in rows.columns:
        before = F.coalesce(PAST, before)
    code = F
    for action, letter in CODES.items():
        code = code.when(F.col(ACTION) == action, letter)
    past = F.concat(before, code.otherwise("-"))
    return rows.withColumn(PAST, past).drop(ACTION, ORDINAL)
