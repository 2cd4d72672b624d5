"""Errors raised by change operations."""

from __future__ import annotations

from collections.abc import Iterator

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import PySparkException


class ChangeError(Exception):
    """Base of every error this package raises."""


class ConfigurationError(ChangeError, ValueError):
    """The operation cannot be carried out as it was described."""


class DuplicateKeysError(ConfigurationError):
    """The source repeats a match key where each key may occur only once."""


class ConstraintError(ChangeError):
    """A row breaks a declared rule: null key, required value, length or unique key."""


class ExecutionError(ChangeError):
    """Spark could not carry the operation out."""


class _Shortfall(ChangeError):
    reason = ""

    def __init__(self, expected: int, actual: int):
        super().__init__(f"{self.reason}: expected {expected} rows, applied {actual}")
        self.expected = expected
        self.actual = actual


class ConcurrencyMismatch(_Shortfall):
    """Fewer rows changed than were sent."""

    reason = "concurrency mismatch"


class NotMatched(_Shortfall):
    """Some source rows met no target row."""

    reason = "unmatched source rows"


# Marks carried by the checks that run inside a Spark plan, so that a failed job
# can be told apart by the rule that stopped it.
DUPLICATE_MARK = "[duplicate match key]"
CONSTRAINT_MARK = "[constraint]"


# A job in which several stages fail at once surfaces as the second kind.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


# Fixed value: the condition of an error that a plan raises itself.
RAISED = "USER_RAISED_EXCEPTION"


def translated(error: Exception) -> ChangeError:
    """The package error that stands for a failed Spark job.

    Only what a plan raised counts: a mark may also stand in the plan that another error prints.
    """
    for message in _raised(error):
        for mark, kind in ((DUPLICATE_MARK, DuplicateKeysError), (CONSTRAINT_MARK, ConstraintError)):
            if message.startswith(mark):
                return kind(message)
    return ExecutionError(str(error))


def _raised(error: Exception) -> Iterator[str]:
    """The messages of ``raise_error`` among an error and its causes."""
    thrown = getattr(error, "_origin", None) or getattr(error, "java_exception", None)
    context = SparkContext._active_spark_context
    while thrown is not None and context is not None:
        if is_instance_of(context._gateway, thrown, "org.apache.spark.SparkThrowable") and thrown.getCondition() == RAISED:
            yield thrown.getMessageParameters().get("errorMessage")
        thrown = thrown.getCause()
