"""The four operations and their options.

    merge(books, feed, spec).match_on("isbn").delete_unmatched().output("id").plan()

An operation is an immutable description; every option returns a new one. ``plan`` checks it against
both schemas and returns a lazy ``ChangeResult``; ``save`` writes the next snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Self

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import CONSTRAINT_MARK, SPARK_ERRORS, ConfigurationError, translated
from rowtide.operators import classify
from rowtide.operators.classify import DELETED, Subject
from rowtide.operators.duplicates import KEEP_LAST, REJECT, keep_last, keep_single
from rowtide.operators.identity import with_ordinal
from rowtide.operators.outcome import ChangeResult, Counts, Guards, enriched_source, once
from rowtide.operators.staging import FOLDED, SEQUENCE, renamed, sent, stage
from rowtide.plans.joins import join_on_keys
from rowtide.plans.roles import ACTION, DELETE, INSERT, MERGE, ORDINAL, UPDATE, Choices, Roles, distinct, resolve_roles
from rowtide.sources.tables import Layout, laid_out_as, point_to, qualified, read_table
from rowtide.spec import TableSpec


@dataclass(frozen=True)
class Operation:
    """Options that every operation has."""

    source: DataFrame
    spec: TableSpec
    target: DataFrame | None = None
    choices: Choices = Choices()
    mapping: Mapping[str, str] = field(default_factory=dict)
    guards: Guards = Guards()
    table_name: str | None = None
    schema_name: str | None = None
    ordinal_column: str | None = None
    sequence_column: str | None = None
    sequence_is_distinct: bool = False
    number_in_place: bool = False
    null_keys: str = "reject"
    collation: str | None = None
    null_defaults: bool = False
    duplicates: str | None = None
    mirror: bool = False
    joins: str = "auto"
    layout: Layout = Layout()
    sort_columns: tuple[str, ...] | None = None
    elsewhere: DataFrame | None = None
    on_progress: Callable[[int], None] | None = None

    kind = ""

    def table(self, name: str) -> Self:
        """Work on another table than the spec names (where no target frame was given)."""
        return replace(self, table_name=name)

    def schema(self, name: str) -> Self:
        """Work in another schema than the spec names (where no target frame was given)."""
        return replace(self, schema_name=name)

    def columns(self, *names: str) -> Self:
        """Restrict the operation to these columns. Repeated calls add up."""
        return self._choose(whitelist=distinct((self.choices.whitelist or ()) + names))

    def rename(self, mapping: Mapping[str, str]) -> Self:
        """Source column name -> target column name."""
        return replace(self, mapping={**self.mapping, **mapping})

    def ordinal(self, column: str) -> Self:
        """A unique integer column of the source that names its rows in the change set."""
        return replace(self, ordinal_column=column)

    def sequence(self, column: str, distinct_per_key: bool = False) -> Self:
        """The column that orders the source; of rows with one key, the last counts.

        Equal values are told apart by the other columns, unless ``distinct_per_key`` promises that
        no key has two rows with one value.
        """
        return replace(self, sequence_column=column, sequence_is_distinct=distinct_per_key)

    def number_as_read(self) -> Self:
        """Number the source rows by their place in the input instead of freezing them first.

        The numbers have gaps wide enough to need a long id, and are only stable for a source that
        reads the same every time, such as a folder of files; in return nothing is written first.
        """
        return replace(self, number_in_place=True)

    def ignore_null_keys(self) -> Self:
        """Let source rows with a null match key match nothing. By default they stop the job."""
        return replace(self, null_keys="ignore")

    def collate_keys(self, collation: str) -> Self:
        """Compare text match keys under a collation such as ``UTF8_LCASE``."""
        return replace(self, collation=collation)

    def batch_size(self, rows: int) -> Self:
        """Rows per written file."""
        return replace(self, layout=replace(self.layout, rows_per_file=rows))

    def ordered(self, *columns: str) -> Self:
        """Write the snapshot in ranges of these columns, by default of the match columns."""
        return replace(self, sort_columns=columns)

    def progress(self, callback: Callable[[int], None]) -> Self:
        """Call back with the running number of rows written, while they are, and with the whole at the end."""
        return replace(self, on_progress=callback)

    def plan(self) -> ChangeResult:
        """Check the description against both schemas and derive the outcome.

        Starts a job in one case only: to number source rows that have no number of their own. Where a large
        source meets a target whose match key may repeat, the first read of the outcome looks for hot keys, once.
        """
        operation = self._informed()
        target, source, roles = operation._resolved()
        try:
            return operation._outcome(operation._subject(target, roles), source)
        except SPARK_ERRORS as error:
            raise translated(error) from error

    def validate(self) -> None:
        """Check the description against both schemas; reads nothing."""
        self._informed()._resolved()

    def located(self, table: DataFrame) -> DataFrame:
        """The rows of ``table`` whose match key the source names, tokens aside."""
        operation = self.on(table)._informed()
        _, source, roles = operation._resolved()
        subject = operation._subject(table, roles)
        keys = stage(
            source, operation.spec, subject.schema, columns=roles.match, match=roles.match, checked=(), ordinal=None,
            sequence=None, null_keys=self.null_keys, folded=subject.folded, collation=self.collation,
        ).select(*subject.sent_keys(roles.match)).distinct()
        pairs = subject.pairs(roles.match)
        return join_on_keys(subject.target, keys, pairs, "left_semi", roles.target_is_unique, subject.hot_keys)

    def _informed(self) -> Self:
        """The operation with its target read, and the defaults that the table itself declares."""
        target = self._target()
        return replace(self, target=target, spec=self.spec.with_defaults_of(target.schema))

    def _resolved(self) -> tuple[DataFrame, DataFrame, Roles]:
        self.spec.check_against(self.target.schema)
        source = renamed(self.source, self.mapping)
        return self.target, source, self._roles(self.target, source)

    def check(self) -> Counts:
        """Count the changes and raise on a violated guard; writes nothing."""
        return self.plan().check()

    def save(self, path: str) -> Counts:
        """Write the next snapshot to a new folder and return the counters."""
        result = self.plan()
        return result.save(path, self.laid_out(result.match), self.on_progress)

    def laid_out(self, match: tuple[str, ...], layout: Layout | None = None) -> Layout:
        """The layout that the options ask for, on top of ``layout``."""
        layout = layout or Layout()
        if self.layout.rows_per_file is not None:
            layout = replace(layout, rows_per_file=self.layout.rows_per_file)
        if self.sort_columns is not None:
            layout = replace(layout, sort_by=self.sort_columns or match or self.spec.keys)
        return layout

    def save_table(self, name: str, buckets: int) -> Counts:
        """Write the next snapshot as a new catalog table in hash buckets of the match columns, which
        later operations on those columns join without shuffling it."""
        result = self.plan()
        if not self.spec.identifies(result.match):
            raise ConfigurationError("a table is bucketed by a unique key, so that no bucket outgrows the others")
        if self.sort_columns is not None:
            raise ConfigurationError("buckets are sorted by their key: leave out ordered")
        return result.save_table(name, buckets, self.layout, self.on_progress)

    def commit(self, path: str) -> Counts:
        """Write the next snapshot of a catalog table to a new folder and let the table point there.

        Readers see the old snapshot until the last step, which touches the catalog only. The new files have the
        partitions and buckets of the table.
        """
        spark, result = self.source.sparkSession, self.plan()
        layout = laid_out_as(spark, self._table(), self.laid_out(result.match))
        counts = result.save(path, layout, self.on_progress)
        point_to(spark, self._table(), path)
        return counts

    def _table(self) -> str:
        return qualified(self.spec, self.table_name, self.schema_name)

    def on(self, target: DataFrame, elsewhere: DataFrame | None = None) -> Self:
        """The same operation on another target.

        A target may be the part of a table that the source can reach. ``elsewhere`` then holds the
        other rows; they are only consulted for generated ids and unique keys.
        """
        return replace(self, target=target, elsewhere=elsewhere)

    def _target(self) -> DataFrame:
        if self.target is not None:
            return self.target
        return read_table(self.source.sparkSession, self.spec, self.table_name, self.schema_name)

    def _roles(self, target: DataFrame, source: DataFrame) -> Roles:
        chosen = self.choices
        translate = lambda names: names and tuple(self.mapping.get(n, n) for n in names)
        chosen = replace(
            chosen,
            whitelist=translate(chosen.whitelist), match=translate(chosen.match),
            insert=translate(chosen.insert), update=translate(chosen.update),
            output=translate(chosen.output) or (),
            identity=self.mapping.get(chosen.identity, chosen.identity),
        )
        return resolve_roles(self.kind, self.spec, target.schema, source.columns, chosen)

    def _subject(self, target: DataFrame, roles: Roles) -> Subject:
        if self.collation is None:
            return Subject(target, self.spec, roles, elsewhere=self.elsewhere)
        folded = frozenset(n for n in roles.match if isinstance(target.schema[n].dataType, T.StringType))
        if folded:
            # Values that differ in the table may be equal under the collation.
            roles = replace(roles, target_is_unique=False)
        return Subject(target, self.spec, roles, folded, self.elsewhere, self.collation).over(target)

    def _choose(self, **changes) -> Self:
        return replace(self, choices=replace(self.choices, **changes))

    def _wants_output(self) -> bool:
        return bool(self.choices.output) or self.choices.output_generated

    def _numbered(self, source: DataFrame, needs_ordinal: bool, makes_ids: bool = False) -> DataFrame:
        """``source`` with its ordinal in place, numbering the rows if nothing else does.

        Numbers that ids are made from may not repeat; a repeated one stops the job.
        """
        if ORDINAL in source.columns:
            return source
        if self.ordinal_column is not None:
            number = F.col(self._called(self.ordinal_column)).cast("long")
            if needs_ordinal:
                wrong = F.raise_error(F.concat(F.lit(f"{CONSTRAINT_MARK} ordinal "), F.coalesce(number.cast("string"), F.lit("null"))))
                number = F.when(number >= 0, number).otherwise(wrong.cast("long"))
            numbered = source.withColumn(ORDINAL, number)
            return keep_single(numbered, [ORDINAL]) if makes_ids else numbered
        if not needs_ordinal:
            return source
        if self.number_in_place:
            return source.withColumn(ORDINAL, F.monotonically_increasing_id())
        return with_ordinal(source, self._sequence())

    def _called(self, name: str) -> str:
        return self.mapping.get(name, name)

    def _sequence(self) -> str | None:
        return None if self.sequence_column is None else self._called(self.sequence_column)

    def _staged(self, subject: Subject, source: DataFrame) -> DataFrame:
        roles = subject.roles
        sequence = self._sequence() or (ORDINAL if ORDINAL in source.columns else None)
        return stage(
            source, self.spec, subject.schema,
            columns=roles.staged(self.kind), match=roles.match,
            checked=distinct(roles.insert + roles.update),
            ordinal=ORDINAL if ORDINAL in source.columns else None,
            sequence=sequence, null_keys=self.null_keys, nulls_take_defaults=self.null_defaults,
            folded=subject.folded, collation=self.collation,
        )

    def _one_per_key(self, subject: Subject, staged: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        sequence = SEQUENCE if SEQUENCE in staged.columns else None
        known_distinct = self.sequence_is_distinct or self.sequence_column is None
        return keep_last(staged, subject.sent_keys(keys), sequence, known_distinct, self.null_keys == "ignore")

    def _single(self, subject: Subject, staged: DataFrame) -> DataFrame:
        return keep_single(staged, subject.sent_keys(subject.roles.match), self.null_keys == "ignore")

    def _result(
        self,
        subject: Subject,
        source: DataFrame,
        staged: DataFrame,
        find_rows: Callable[[], DataFrame],
        at_risk: tuple[tuple[str, ...], ...] = (),
        searches: bool = False,
        **more,
    ) -> ChangeResult:
        roles = subject.roles
        for name in ("find_new", "find_kept", "find_removed"):
            if name in more:
                more[name] = once(more[name])

        def to_changes(frame: DataFrame) -> DataFrame:
            after = F.when(F.col(ACTION) != DELETED, F.lit(True))
            shown = [
                F.when(after, F.col(n)).alias(n) if self.mirror and n not in roles.match else F.col(n)
                for n in distinct(roles.match + roles.output)
            ]
            return frame.where(F.col(ACTION).isNotNull()).select(ORDINAL, ACTION, *shown)

        if ORDINAL in source.columns and self._wants_output():
            sole = not roles.match or roles.target_is_unique
            own = _with_source_names(source, self.mapping)
            more["enriched"] = lambda made: enriched_source(
                own, made, roles.output, self.mapping, self.spec.enums, sole
            )
        result = ChangeResult(
            kind=self.kind, find_rows=once(find_rows), changes_of=to_changes, staged=staged,
            table_columns=subject.table_columns,
            match=roles.match, guards=self.guards, elsewhere=self.elsewhere,
            at_risk={group: _new_values(staged, group) for group in at_risk}, **more,
        )
        if not searches:
            # Starts no job, and shows at once what cannot be planned.
            result.rows
        return result

    def _unapplied(self, subject: Subject, staged: DataFrame, unique: bool) -> dict[str, Callable]:
        """How to find the staged rows that met no target row, or one with another token."""
        def absent_from(table: DataFrame | None) -> DataFrame:
            return _target_names(classify.absent(subject if table is None else subject.over(table), staged, unique))

        found = {"find_unmatched": absent_from}
        if subject.roles.check:
            found["find_stale"] = lambda: _target_names(classify.stale(subject, staged, unique))
        return found

    def _outcome(self, subject: Subject, source: DataFrame) -> ChangeResult:
        raise NotImplementedError


class _Keyed(Operation):
    """Options of the operations that match existing rows."""

    def match_on(self, *names: str) -> Self:
        """Match on these columns instead of the key. Repeated calls add up."""
        return self._choose(match=distinct((self.choices.match or ()) + names))

    def check_token(self, on: bool = True) -> Self:
        """Change a row only if its token equals the source's. On by default."""
        return self._choose(check_token=on)

    def fail_on_mismatch(self) -> Self:
        """Raise unless every source row applied."""
        return replace(self, guards=replace(self.guards, no_mismatch=True))


class _Returning(Operation):
    """Options of the operations that return values to their source rows."""

    def output(self, *names: str) -> Self:
        """Return these columns in the change set."""
        return self._choose(output=self.choices.output + names)

    def output_generated(self) -> Self:
        """Return every column the table fills itself."""
        return self._choose(output_generated=True)


class Insert(_Returning):
    """Add source rows to the table."""

    kind = INSERT

    def identity_column(self, name: str) -> Self:
        """Treat this column as generated."""
        return self._choose(identity=name)

    def keep_identity(self) -> Self:
        """Store the ids the source brings along."""
        return self._choose(keep_identity=True)

    def if_missing(self, *match: str) -> Self:
        """Add only rows whose match columns (by default the key) are not in the table yet."""
        return self._choose(insert_if_missing=True, match=distinct((self.choices.match or ()) + match) or None)

    def nulls_take_defaults(self) -> Self:
        """Store a column's default where the source holds null. By default null stays null."""
        return replace(self, null_defaults=True)

    def on_duplicates(self, policy: str) -> Self:
        """With ``last``, add one row per missing key; with ``reject``, a repeated key stops the job. By default
        all rows are added. Both need ``if_missing``."""
        if policy not in (KEEP_LAST, REJECT):
            raise ConfigurationError(f"unknown duplicate policy '{policy}'")
        return replace(self, duplicates=policy)

    def append_to(self, path: str) -> Counts:
        """Add the new rows to an existing folder instead of writing a snapshot."""
        result = self.plan()
        return result.append_to(path, self.laid_out(result.match), self.on_progress)

    def append(self) -> Counts:
        """Add the new rows to the catalog table instead of writing a snapshot."""
        if self.layout.rows_per_file is not None or self.sort_columns is not None:
            raise ConfigurationError("a catalog table decides on its own files: leave out batch_size and ordered")
        return self.plan().append_to_table(self._table(), self.on_progress)

    def _outcome(self, subject: Subject, source: DataFrame) -> ChangeResult:
        roles = subject.roles
        generates = roles.identity is not None and roles.identity not in roles.insert
        source = self._numbered(source, generates or self._wants_output(), generates)
        staged = sent_rows = self._staged(subject, source)
        unique = False
        if self.duplicates is not None and not roles.match:
            raise ConfigurationError("a duplicate policy needs match columns: use if_missing")
        if roles.source_must_be_unique or self.duplicates == REJECT:
            staged, unique = self._single(subject, staged), True
        elif roles.match and self.duplicates == KEEP_LAST:
            staged, unique = self._one_per_key(subject, staged, roles.match), True
        asked = staged

        @once
        def added() -> DataFrame:
            new = classify.absent(subject, asked, unique, asked=sent_rows) if roles.match else asked
            return classify.appended(subject, new)

        def rows() -> DataFrame:
            return classify.untouched(subject).unionByName(added(), allowMissingColumns=True)

        return self._result(
            subject, source, staged, rows, find_new=added, at_risk=_groups_at_risk(subject, unique),
            searches=bool(roles.match) and not unique,
        )


class Update(_Keyed, _Returning):
    """Overwrite columns of the rows that meet a source row."""

    kind = UPDATE

    def update_columns(self, *names: str) -> Self:
        """Write only these columns. Repeated calls add up."""
        return self._choose(update=distinct((self.choices.update or ()) + names))

    def identity_column(self, name: str) -> Self:
        """Treat this column as generated."""
        return self._choose(identity=name)

    def require_all_matched(self, count_source_rows: bool = False) -> Self:
        """Raise unless as many table rows changed as source rows were sent.

        One source row may change several table rows and so hide another's miss;
        ``count_source_rows`` counts the source rows that found a match instead.
        """
        return replace(self, guards=replace(self.guards, all_matched=True, count_source_rows=count_source_rows))

    def _outcome(self, subject: Subject, source: DataFrame) -> ChangeResult:
        roles = subject.roles
        source = self._numbered(source, self._wants_output())
        sent_rows = self._staged(subject, source)
        if roles.source_must_be_unique:
            sent_rows = self._single(subject, sent_rows)
            staged = sent_rows
        else:
            staged = self._one_per_key(subject, sent_rows, roles.match + roles.check)
        return self._result(
            subject, source, sent_rows, lambda: classify.updated(subject, staged),
            at_risk=_groups_at_risk(subject, True), searches=classify.may_search(subject, staged),
            **self._unapplied(subject, sent_rows, roles.source_must_be_unique),
        )


class Delete(_Keyed):
    """Remove the rows that meet a source row."""

    kind = DELETE

    def _outcome(self, subject: Subject, source: DataFrame) -> ChangeResult:
        roles = subject.roles
        source = self._numbered(source, False)
        sent_rows = self._staged(subject, source)
        compared = subject.sent_keys(roles.match + roles.check)
        if roles.source_must_be_unique:
            keys = sent_rows = self._single(subject, sent_rows)
        else:
            keys = sent_rows.select(*compared).distinct()
        return self._result(
            subject, source, sent_rows, lambda: classify.deleted(subject, keys), may_delete=True,
            find_kept=lambda: classify.remaining(subject, keys), find_removed=lambda: classify.removed(subject, keys),
            searches=classify.may_search(subject, keys),
            **self._unapplied(subject, sent_rows, roles.source_must_be_unique),
        )


class Merge(_Keyed, _Returning):
    """Update the rows that meet a source row, add the others, and optionally delete the rest."""

    kind = MERGE

    def insert_columns(self, *names: str) -> Self:
        """Fill only these columns of a new row. Repeated calls add up."""
        return self._choose(insert=distinct((self.choices.insert or ()) + names))

    def update_columns(self, *names: str) -> Self:
        """Write only these columns of a matched row; called without names, matched rows stay."""
        return self._choose(update=distinct((self.choices.update or ()) + names))

    def delete_unmatched(self) -> Self:
        """Delete table rows the source does not mention. An empty source deletes nothing."""
        return replace(self, mirror=True)

    def on_duplicates(self, policy: str) -> Self:
        """``last`` keeps the last source row per key (default); ``reject`` stops the job."""
        if policy not in (KEEP_LAST, REJECT):
            raise ConfigurationError(f"unknown duplicate policy '{policy}'")
        return replace(self, duplicates=policy)

    def strategy(self, name: str) -> Self:
        """``full`` uses one full outer join, ``split`` a left join plus an anti join, ``auto``
        chooses by the size of the source and the uniqueness of the target's match key."""
        if name not in ("auto", "full", "split"):
            raise ConfigurationError(f"unknown merge strategy '{name}'")
        return replace(self, joins=name)

    def _outcome(self, subject: Subject, source: DataFrame) -> ChangeResult:
        roles = subject.roles
        reject = self.duplicates == REJECT
        unordered = not reject and self._sequence() is None
        generates = roles.identity is not None and roles.identity not in roles.insert
        source = self._numbered(source, generates or self._wants_output() or unordered, generates)
        all_rows = self._staged(subject, source)
        if reject:
            staged = self._single(subject, all_rows)
        else:
            staged = self._one_per_key(subject, all_rows, roles.match)
        rest = _has_rows(source) if self.mirror else None
        full = self.joins == "full" or (self.joins == "auto" and classify.one_join_suffices(subject, staged))

        def rows() -> DataFrame:
            if full:
                return classify.merged_in_one_join(subject, staged, rest)
            added = classify.appended(subject, classify.absent(subject, staged, True, asked=all_rows))
            existing = classify.merged_existing(subject, staged, rest)
            return existing.unionByName(added, allowMissingColumns=True)

        return self._result(
            subject, source, staged, rows,
            may_delete=self.mirror, at_risk=_groups_at_risk(subject, True),
            searches=not full and classify.may_search(subject, staged),
            **self._unapplied(subject, staged, True),
        )


def insert(target: DataFrame | None, source: DataFrame, spec: TableSpec) -> Insert:
    """Add the rows of ``source``."""
    return Insert(source=source, spec=spec, target=target)


def update(target: DataFrame | None, source: DataFrame, spec: TableSpec) -> Update:
    """Overwrite matched rows with the values of ``source``."""
    return Update(source=source, spec=spec, target=target)


def delete(target: DataFrame | None, source: DataFrame, spec: TableSpec) -> Delete:
    """Remove the rows ``source`` names."""
    return Delete(source=source, spec=spec, target=target)


def merge(target: DataFrame | None, source: DataFrame, spec: TableSpec) -> Merge:
    """Upsert the rows of ``source``."""
    return Merge(source=source, spec=spec, target=target)


def _has_rows(source: DataFrame) -> Column:
    return source.limit(1).agg(F.count(F.lit(1)).alias("n")).scalar() > 0


def _target_names(staged: DataFrame) -> DataFrame:
    """Staged rows under the target's column names."""
    own = [n for n in staged.columns if n.startswith(sent("")) or n == ORDINAL]
    own = [n for n in own if not n.startswith(sent(FOLDED))]
    return staged.select(*(F.col(n).alias(n.removeprefix(sent(""))) for n in own))


def _new_values(staged: DataFrame, group: tuple[str, ...]) -> DataFrame | None:
    """The values a unique group can newly take, where all of them come from the source."""
    if not {sent(name) for name in group} <= set(staged.columns):
        return None
    return staged.select(*(F.col(sent(name)).alias(name) for name in group))


def _with_source_names(source: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return source.withColumnsRenamed({theirs: mine for mine, theirs in mapping.items()})


def _groups_at_risk(subject: Subject, unique_source: bool) -> tuple[tuple[str, ...], ...]:
    """Unique column groups in which the operation could produce equal values."""
    spec, roles = subject.spec, subject.roles
    groups = ([spec.keys] if spec.keys else []) + list(spec.unique)
    written = set(roles.insert) | set(roles.update)
    at_risk = []
    for group in groups:
        new_keys_differ = unique_source and bool(roles.match) and set(roles.match) <= set(group)
        generated = roles.identity in group and roles.identity not in roles.insert
        inserts = bool(roles.insert) and not new_keys_differ and not generated
        if set(group) & written and (inserts or set(group) & set(roles.update)):
            at_risk.append(tuple(group))
    return tuple(at_risk)
