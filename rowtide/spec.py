"""What a table's columns mean to a change operation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

from rowtide.errors import ConfigurationError

# The StructField metadata entries that carry a column's role.
ROLE_NAMES = (
    "key", "identity", "computed", "token", "rowversion", "default", "max_length", "enum",
)

# Fixed value: where Spark keeps the DEFAULT expression of a table's column.
TABLE_DEFAULT = "CURRENT_DEFAULT"

_IDENTITY_TYPES = (T.ShortType, T.IntegerType, T.LongType)
_NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType)


def column(name: str, data_type: T.DataType, nullable: bool = True, **roles) -> T.StructField:
    """A schema field with column roles in its metadata, e.g. ``column("id", LongType(), key=True)``."""
    unknown = sorted(set(roles) - set(ROLE_NAMES))
    if unknown:
        raise ConfigurationError(f"unknown column roles: {', '.join(unknown)}")
    return T.StructField(name, data_type, nullable, metadata=roles)


@dataclass(frozen=True)
class TableSpec:
    """Name and column roles of a target table. The table's own schema supplies the types.

    ``defaults`` and ``computed`` map a column to a Spark SQL expression. ``unique`` lists the
    column groups that may not repeat, besides the key. ``enums`` maps a column to its labels and
    their integer codes.
    """

    name: str
    schema: str = "default"
    keys: tuple[str, ...] = ()
    identity: str | None = None
    token: str | None = None
    row_version: str | None = None
    computed: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    required: frozenset[str] = frozenset()
    max_length: Mapping[str, int] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()
    enums: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    @classmethod
    def from_schema(
        cls,
        entity: str,
        fields: T.StructType,
        table: str | None = None,
        schema: str = "default",
        unique: Iterable[tuple[str, ...]] = (),
    ) -> TableSpec:
        """Roles from field metadata; without a marked key, ``id`` or ``<entity>_id`` is the key."""
        if not fields.fields:
            raise ConfigurationError(f"'{entity}' has no columns")
        marked = {role: [f for f in fields if role in f.metadata] for role in ROLE_NAMES}
        keys = [f.name for f in sorted(marked["key"], key=_key_position)]
        identities = [f.name for f in marked["identity"] if f.metadata["identity"]]
        if not keys:
            by_convention = next((f for f in fields if _is_conventional_key(f.name, entity)), None)
            if by_convention is not None:
                keys = [by_convention.name]
                if not identities and isinstance(by_convention.dataType, _IDENTITY_TYPES):
                    identities = [by_convention.name]
        tokens = [f.name for f in fields if f.metadata.get("token") or f.metadata.get("rowversion")]
        versions = [f.name for f in marked["rowversion"] if f.metadata["rowversion"]]
        return cls(
            name=table or entity,
            schema=schema,
            keys=tuple(keys),
            identity=identities[0] if identities else None,
            token=tokens[0] if tokens else None,
            row_version=versions[0] if versions else None,
            computed={f.name: f.metadata["computed"] for f in marked["computed"]},
            defaults={f.name: f.metadata["default"] for f in marked["default"]},
            required=frozenset(f.name for f in fields if not f.nullable) | frozenset(keys),
            max_length={f.name: f.metadata["max_length"] for f in marked["max_length"]},
            unique=tuple(tuple(group) for group in unique),
            enums={f.name: f.metadata["enum"] for f in marked["enum"]},
        )

    def with_defaults_of(self, fields: T.StructType) -> TableSpec:
        """The spec with the ``DEFAULT`` expressions of the table's own columns, where it gives none itself."""
        declared = {f.name: f.metadata[TABLE_DEFAULT] for f in fields if TABLE_DEFAULT in f.metadata}
        return replace(self, defaults={**declared, **self.defaults}) if set(declared) - set(self.defaults) else self

    @property
    def check_column(self) -> str | None:
        """The column compared for optimistic concurrency: a plain token, or the row version."""
        return self.token or self.row_version

    @property
    def generated(self) -> frozenset[str]:
        """Columns the table fills itself."""
        own = {self.identity, self.row_version} - {None}
        return frozenset(own | set(self.computed))

    @property
    def read_only(self) -> frozenset[str]:
        """Columns that are never written from a source."""
        return frozenset({self.row_version} - {None} | set(self.computed))

    def identifies(self, columns: Iterable[str]) -> bool:
        """Whether equal values in ``columns`` can occur in one row of the table only."""
        given = set(columns)
        groups = ([self.keys] if self.keys else []) + list(self.unique)
        return any(set(group) <= given for group in groups)

    def check_against(self, fields: T.StructType) -> None:
        """Every column a role names must exist, and keys must be comparable."""
        known = set(fields.names) | set(self.computed)
        named = set(self.keys) | set(self.defaults) | set(self.required) | set(self.max_length)
        named |= {self.identity, self.token, self.row_version} - {None}
        named |= {name for group in self.unique for name in group} | set(self.enums)
        missing = sorted(named - known)
        if missing:
            raise ConfigurationError(f"table '{self.name}' has no column {', '.join(missing)}")


def reject_nested_keys(fields: T.StructType, keys: Iterable[str]) -> None:
    """Rows cannot be matched on arrays, maps or structs."""
    for name in keys:
        if isinstance(fields[name].dataType, _NESTED_TYPES):
            raise ConfigurationError(f"cannot match on nested column '{name}'")


def _key_position(entry: T.StructField) -> int:
    position = entry.metadata["key"]
    return 0 if isinstance(position, bool) else position


def _is_conventional_key(name: str, entity: str) -> bool:
    plain = name.replace("_", "").lower()
    return plain in ("id", entity.replace("_", "").lower() + "id")
