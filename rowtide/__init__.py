"""Set-based table changes as Spark jobs: insert, update, delete and merge."""

from rowtide.errors import (
    ChangeError,
    ConcurrencyMismatch,
    ConfigurationError,
    ConstraintError,
    DuplicateKeysError,
    ExecutionError,
    NotMatched,
)
from rowtide.operators.operation import delete, insert, merge, update
from rowtide.operators.outcome import ChangeResult, Counts
from rowtide.spec import TableSpec, column

__all__ = [
    "ChangeError",
    "ChangeResult",
    "ConcurrencyMismatch",
    "ConfigurationError",
    "ConstraintError",
    "Counts",
    "DuplicateKeysError",
    "ExecutionError",
    "NotMatched",
    "TableSpec",
    "column",
    "delete",
    "insert",
    "merge",
    "update",
]
