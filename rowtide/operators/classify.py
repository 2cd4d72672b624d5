"""What happens to each row: one frame of post-change rows per operation.

Every function returns rows in the target's columns plus ``action`` (null for an untouched row) and
``__bulk_index`` (the source row that caused the change). Snapshot, change set and counters are
selections from that frame.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.identity import generated_id, next_value
from rowtide.operators.staging import FOLDED, HIT, default_value, sent
from rowtide.plans.joins import equal, fits_broadcast, hot_keys, is_large, join_on_keys, missing_from
from rowtide.plans.roles import ACTION, ORDINAL, PAST, Roles
from rowtide.spec import TableSpec

# The actions a row can undergo.
INSERTED, UPDATED, DELETED = "INSERT", "UPDATE", "DELETE"

_LIVE = "__live"
# What stands in ``PAST`` for an action.
CODES = {INSERTED: "I", UPDATED: "U", DELETED: "D"}


def lives(rows: DataFrame) -> Column:
    """Whether no earlier operation of a chain deleted a row. Deleted ones travel along to be counted at the end."""
    return F.coalesce(~rows[PAST].contains(CODES[DELETED]), F.lit(True)) if PAST in rows.columns else F.lit(True)


def living(rows: DataFrame) -> DataFrame:
    """``rows`` without those that an earlier operation of a chain deleted."""
    return rows.where(lives(rows)) if PAST in rows.columns else rows


@dataclass(frozen=True)
class Subject:
    """The table side of an operation.

    ``folded`` names text match columns that are compared under a collation; both sides then carry
    a comparison column next to the stored one. ``elsewhere`` holds the rows of the table that
    ``target`` leaves out.
    """

    target: DataFrame
    spec: TableSpec
    roles: Roles
    folded: frozenset[str] = frozenset()
    elsewhere: DataFrame | None = None
    collation: str | None = None
    searched: dict[tuple[str, ...], DataFrame | None] = field(default_factory=dict, compare=False)

    def over(self, table: DataFrame) -> Subject:
        """The same with another table."""
        compared = {FOLDED + name: F.collate(F.col(name), self.collation) for name in sorted(self.folded)}
        return replace(self, target=table.withColumns(compared) if compared else table, searched={})

    def hot_keys(self, keys: Sequence[str]) -> DataFrame | None:
        """Keys that fill much of the table, looked for once an operation."""
        known = tuple(keys)
        if known not in self.searched:
            self.searched[known] = hot_keys(self.target, keys)
        return self.searched[known]

    @property
    def schema(self) -> T.StructType:
        return self.target.schema

    @property
    def columns(self) -> list[str]:
        return [name for name in self.target.columns if not name.startswith(FOLDED) and name != PAST]

    @property
    def past(self) -> list[str]:
        return [PAST] if PAST in self.target.columns else []

    @property
    def table_columns(self) -> tuple[str, ...]:
        """The columns of a snapshot: those of the table, and computed ones that it does not store."""
        own = self.columns
        return (*own, *(name for name in self.spec.computed if name not in own))

    def values_of(self, name: str) -> DataFrame:
        """One column of the whole table."""
        values = living(self.target).select(name)
        return values if self.elsewhere is None else values.union(self.elsewhere.select(name))

    def keys(self, names: Iterable[str]) -> list[str]:
        """The target columns that are compared for ``names``."""
        return [FOLDED + name if name in self.folded else name for name in names]

    def sent_keys(self, names: Iterable[str]) -> list[str]:
        """The staged columns that are compared for ``names``."""
        return [sent(name) for name in self.keys(names)]

    def pairs(self, names: Sequence[str]) -> list[tuple[str, str]]:
        return list(zip(self.keys(names), self.sent_keys(names)))


def untouched(subject: Subject) -> DataFrame:
    """The target as it is."""
    return _with_computed(subject, subject.target.select(*subject.columns, *_no_change(), *subject.past))


def appended(subject: Subject, staged: DataFrame) -> DataFrame:
    """Every staged row as a new table row."""
    values = [_new_value(subject, name, staged).alias(name) for name in subject.columns]
    return _with_computed(subject, staged.select(*values, F.lit(INSERTED).alias(ACTION), _ordinal(staged)))


def absent(
    subject: Subject, staged: DataFrame, staged_is_unique: bool, asked: DataFrame | None = None
) -> DataFrame:
    """Staged rows whose key the target does not hold. ``asked`` holds the same keys before
    duplicates were dropped."""
    pairs = [(theirs, mine) for mine, theirs in subject.pairs(subject.roles.match)]
    return missing_from(
        staged, living(subject.target), pairs, staged_is_unique, subject.roles.target_is_unique, asked
    )


def stale(subject: Subject, staged: DataFrame, staged_is_unique: bool) -> DataFrame:
    """Staged rows whose key the target holds, but never with the token they carry."""
    roles = subject.roles

    def narrowed(rows: DataFrame, names: Sequence[str], how: str) -> DataFrame:
        held = living(subject.target).select(*subject.keys(names))
        pairs = [(theirs, mine) for mine, theirs in subject.pairs(names)]
        return join_on_keys(rows, held if roles.target_is_unique else held.distinct(), pairs, how, staged_is_unique)

    met = narrowed(staged, roles.match, "left_semi")
    return narrowed(met, roles.match + roles.check, "left_anti")


def updated(subject: Subject, staged: DataFrame) -> DataFrame:
    """The target with matched rows overwritten. ``staged`` holds each match key once."""
    roles = subject.roles
    joined = _left_joined(subject, staged, roles.match + roles.check)
    action = F.when(F.col(HIT), F.lit(UPDATED))
    return _after_change(subject, joined.withColumn(ACTION, action), may_insert=False)


def deleted(subject: Subject, staged: DataFrame) -> DataFrame:
    """The target with the action ``DELETE`` on every row that meets a staged row."""
    joined = _left_joined(subject, staged, subject.roles.match + subject.roles.check)
    action = F.when(F.col(HIT), F.lit(DELETED)).alias(ACTION)
    no_source = F.lit(None).cast("long").alias(ORDINAL)
    return _with_computed(subject, joined.select(*subject.columns, action, no_source, *subject.past))


def removed(subject: Subject, staged: DataFrame) -> DataFrame:
    """Target rows that meet a staged row."""
    return _by_key_and_token(subject, staged, "left_semi")


def remaining(subject: Subject, staged: DataFrame) -> DataFrame:
    """Target rows that meet no staged row."""
    return _by_key_and_token(subject, staged, "left_anti")


def merged_in_one_join(subject: Subject, staged: DataFrame, delete_rest: Column | None) -> DataFrame:
    """Matched, new and unmatched rows from one full outer join: each side is read once.

    Only for targets whose match key is unique; a full outer join cannot split a hot key.
    """
    target = subject.target.withColumn(_LIVE, F.lit(True))
    source = staged.withColumn(HIT, F.lit(True))
    met = equal(target, source, subject.pairs(subject.roles.match)) & lives(target)
    joined = target.join(source, met, "full_outer")
    is_new = F.col(HIT) & F.col(_LIVE).isNull()
    action = _first_of([(is_new, INSERTED), *_branches_of_existing(subject, F.col(_LIVE) & lives(joined), delete_rest)])
    return _after_change(subject, joined.withColumn(ACTION, action), may_insert=True)


def merged_existing(subject: Subject, staged: DataFrame, delete_rest: Column | None) -> DataFrame:
    """The existing rows of a merge; new rows come from ``absent``."""
    if not subject.roles.update and delete_rest is None:
        return untouched(subject)
    joined = _left_joined(subject, staged, subject.roles.match)
    action = _first_of(_branches_of_existing(subject, lives(joined), delete_rest))
    return _after_change(subject, joined.withColumn(ACTION, action), may_insert=False)


def may_search(subject: Subject, staged: DataFrame) -> bool:
    """Whether joining the table to ``staged`` starts with a search for hot keys."""
    return not subject.roles.target_is_unique and not fits_broadcast(staged)


def one_join_suffices(subject: Subject, staged: DataFrame) -> bool:
    """Whether a merge should use the full outer join.

    A target with repeated match keys needs joins that can split them. And a large target is not
    shuffled for the sake of a small source, which the two-part plan broadcasts to it.
    """
    if not subject.roles.target_is_unique:
        return False
    return not (is_large(subject.target) and fits_broadcast(staged))


def _by_key_and_token(subject: Subject, staged: DataFrame, how: str) -> DataFrame:
    roles = subject.roles
    pairs = subject.pairs(roles.match + roles.check)
    met = join_on_keys(living(subject.target), staged, pairs, how, roles.target_is_unique, subject.hot_keys)
    return _with_computed(subject, met.select(*subject.columns))


def _left_joined(subject: Subject, staged: DataFrame, names) -> DataFrame:
    marked = staged.withColumn(HIT, F.lit(True))
    pairs = subject.pairs(names)
    unique = subject.roles.target_is_unique
    return join_on_keys(subject.target, marked, pairs, "left", unique, subject.hot_keys, only=lives)


def _branches_of_existing(subject: Subject, live: Column, delete_rest: Column | None):
    """What can happen to an existing row. A matched row with a stale token takes no branch."""
    branches = []
    if subject.roles.update:
        applies = F.col(HIT) & live
        for token in subject.roles.check:
            applies = applies & (F.col(token) == F.col(sent(token)))
        branches.append((applies, UPDATED))
    if delete_rest is not None:
        branches.append((F.col(HIT).isNull() & live & delete_rest, DELETED))
    return branches


def _first_of(branches) -> Column:
    action = F
    for condition, name in branches:
        action = action.when(condition, F.lit(name))
    return action


def _after_change(subject: Subject, joined: DataFrame, may_insert: bool) -> DataFrame:
    spec, roles = subject.spec, subject.roles
    is_update, is_insert = F.col(ACTION) == UPDATED, F.col(ACTION) == INSERTED
    values = []
    for name in subject.columns:
        before = F.col(name)
        if name == spec.row_version:
            changes = is_update | is_insert if may_insert else is_update
            values.append(F.when(changes, _next_version(subject)).otherwise(before).alias(name))
            continue
        branches = F
        if name in roles.update:
            branches = branches.when(is_update, F.col(sent(name)))
        if may_insert:
            branches = branches.when(is_insert, _new_value(subject, name, joined))
        values.append(before if branches is F else branches.otherwise(before).alias(name))
    return _with_computed(subject, joined.select(*values, ACTION, _ordinal(joined), *subject.past))


def _new_value(subject: Subject, name: str, staged: DataFrame) -> Column:
    spec, roles = subject.spec, subject.roles
    data_type = subject.schema[name].dataType
    if name == spec.row_version:
        return _next_version(subject)
    if name in roles.insert:
        return F.col(sent(name))
    if name == roles.identity:
        return generated_id(subject.values_of(name), name, data_type)
    return default_value(spec, name, subject.schema)


def _next_version(subject: Subject) -> Column:
    name = subject.spec.row_version
    return next_value(subject.values_of(name), name).cast(subject.schema[name].dataType)


def _with_computed(subject: Subject, frame: DataFrame) -> DataFrame:
    """``frame`` with every computed column evaluated on every row, whether the table stores it or not."""
    computed = {name: F.expr(text) for name, text in subject.spec.computed.items()}
    if not computed:
        return frame
    types = {name: subject.schema[name].dataType for name in computed if name in subject.columns}
    return frame.withColumns({n: e.cast(types[n]) if n in types else e for n, e in computed.items()})


def _ordinal(frame: DataFrame) -> Column:
    return F.col(ORDINAL) if ORDINAL in frame.columns else F.lit(None).cast("long").alias(ORDINAL)


def _no_change() -> tuple[Column, Column]:
    return F.lit(None).cast("string").alias(ACTION), F.lit(None).cast("long").alias(ORDINAL)
