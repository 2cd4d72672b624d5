"""Which columns take part in an operation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

from rowtide.errors import ConfigurationError
from rowtide.spec import TableSpec, reject_nested_keys

INSERT, UPDATE, DELETE, MERGE = "insert", "update", "delete", "merge"

# The columns that an operation adds to a row, its source row's number and what became of it.
ORDINAL = "__bulk_index"
ACTION = "action"
# What earlier operations of a chain did to a row, a letter each.
PAST = "__past"


@dataclass(frozen=True)
class Choices:
    """Column selections of one operation, all in target names. ``None`` means not chosen."""

    whitelist: tuple[str, ...] | None = None
    match: tuple[str, ...] | None = None
    insert: tuple[str, ...] | None = None
    update: tuple[str, ...] | None = None
    output: tuple[str, ...] = ()
    output_generated: bool = False
    identity: str | None = None
    keep_identity: bool = False
    insert_if_missing: bool = False
    check_token: bool = True


@dataclass(frozen=True)
class Roles:
    """The column lists of one operation."""

    match: tuple[str, ...]
    insert: tuple[str, ...]
    update: tuple[str, ...]
    check: tuple[str, ...]
    output: tuple[str, ...]
    identity: str | None
    source_must_be_unique: bool
    target_is_unique: bool

    def staged(self, kind: str) -> tuple[str, ...]:
        """The source columns the operation reads; everything else is pruned."""
        payload = {
            DELETE: (),
            UPDATE: self.update,
            MERGE: self.insert + self.update,
            INSERT: self.insert,
        }[kind]
        return distinct(self.match + payload + self.check)


def distinct(names: Iterable[str]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(names))


def resolve_roles(
    kind: str, spec: TableSpec, target: T.StructType, sent: Iterable[str], choices: Choices
) -> Roles:
    """Column lists for ``kind``, given the target's schema and the columns the source sends."""
    sent = tuple(sent)
    table_columns = distinct(tuple(target.names) + tuple(spec.computed))
    _require_known(choices, table_columns, sent, spec)

    identity = choices.identity or spec.identity
    allowed = choices.whitelist if choices.whitelist is not None else table_columns
    usable = tuple(name for name in allowed if name in sent)

    match = _match_columns(kind, spec, choices)
    reject_nested_keys(target, match)
    missing = [name for name in match if name not in sent]
    if missing:
        raise ConfigurationError(f"the source has no match column {', '.join(missing)}")

    roles = Roles(
        match=match,
        insert=_insert_columns(kind, spec, choices, usable, identity),
        update=_update_columns(kind, spec, choices, usable, identity),
        check=_check_columns(kind, spec, choices, usable),
        output=_output_columns(spec, choices, allowed, identity),
        identity=None if choices.keep_identity else identity,
        source_must_be_unique=kind != MERGE and bool(set(match) & set(spec.keys)),
        target_is_unique=spec.identifies(match),
    )
    _reject_impossible(kind, roles, choices)
    return roles


def _require_known(choices: Choices, table_columns, sent, spec: TableSpec) -> None:
    chosen = (
        (choices.match or ()) + (choices.insert or ()) + (choices.update or ()) + choices.output
        + (choices.whitelist or ()) + ((choices.identity,) if choices.identity else ())
    )
    unknown = [name for name in distinct(chosen) if name not in table_columns]
    if unknown:
        raise ConfigurationError(f"table '{spec.name}' has no column {', '.join(unknown)}")
    written = (choices.insert or ()) + (choices.update or ())
    written += tuple(n for n in choices.whitelist or () if n not in spec.generated)
    unsent = [name for name in distinct(written) if name not in sent and name not in spec.read_only]
    if unsent:
        raise ConfigurationError(f"the source has no column {', '.join(unsent)}")


def _match_columns(kind: str, spec: TableSpec, choices: Choices) -> tuple[str, ...]:
    if kind == INSERT and not choices.insert_if_missing:
        return ()
    match = choices.match or spec.keys
    if not match:
        raise ConfigurationError(f"{kind} requires match keys")
    return distinct(match)


def _insert_columns(kind, spec, choices, usable, identity) -> tuple[str, ...]:
    if kind in (UPDATE, DELETE):
        return ()
    if choices.insert is not None:
        return tuple(n for n in distinct(choices.insert) if n not in spec.read_only)
    skipped = spec.read_only if choices.keep_identity else spec.read_only | {identity}
    return tuple(n for n in usable if n not in skipped)


def _update_columns(kind, spec, choices, usable, identity) -> tuple[str, ...]:
    if kind in (INSERT, DELETE):
        return ()
    fixed = spec.read_only | set(spec.keys)
    if choices.update is not None:
        return tuple(n for n in distinct(choices.update) if n not in fixed)
    fixed = fixed | {spec.check_column, spec.token, identity}
    return tuple(n for n in usable if n not in fixed)


def _check_columns(kind, spec, choices, usable) -> tuple[str, ...]:
    token = spec.check_column
    if kind == INSERT or not choices.check_token or token not in usable:
        return ()
    return (token,)


def _output_columns(spec, choices, allowed, identity) -> tuple[str, ...]:
    generated = spec.generated | ({identity} - {None})
    automatic = tuple(n for n in allowed if n in generated) if choices.output_generated else ()
    return distinct(automatic + choices.output)


def _reject_impossible(kind: str, roles: Roles, choices: Choices) -> None:
    if choices.keep_identity and (choices.output or choices.output_generated):
        raise ConfigurationError("keeping identity values cannot be combined with output")
    if kind == UPDATE and not roles.update:
        raise ConfigurationError("update has no column to write")
