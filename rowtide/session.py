"""Freezing intermediate results, and reading what was observed on the way."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from rowtide.errors import ConfigurationError

# Fixed value: what Spark throws for an observation that no plan carried out.
NEVER_DELIVERED = "java.lang.AssertionError"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names one in ``spark.checkpoint.dir``, and that one is always used. Only a session
    that runs in a single local process may fall back to a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if named:
        context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise ConfigurationError("set spark.checkpoint.dir to a folder that every executor shares")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rowtide-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def frozen(df: DataFrame) -> DataFrame:
    """``df`` with its rows, row order and partitions fixed on shared storage.

    A reliable checkpoint: it outlives executors, and no later read can see other values.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(seen: Observation) -> dict[str, int]:
    """The values an observation took; none if the optimizer knew that no row would get past it and left it out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if error.java_exception.getClass().getName() != NEVER_DELIVERED:
            raise
        return {}
