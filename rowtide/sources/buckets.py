"""A snapshot in hash buckets of its key, of which a change rewrites only those it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import ConfigurationError
from rowtide.operators.operation import Insert, Merge, Operation, Update
from rowtide.sources.partitions import FolderTable
from rowtide.sources.tables import BUCKET, Layout, bucket_of


@dataclass(frozen=True)
class BucketedTable(FolderTable):
    """A Parquet folder partitioned by ``bucket``, a hash of the key columns.

    An operation that matches on those columns finds the buckets it may change from its source alone.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int

    @property
    def layout(self) -> Layout:
        return Layout(bucket_by=self.keys, buckets=self.buckets)

    def bucket_of(self, columns: dict[str, str] | None = None) -> Column:
        """The bucket of a row; ``columns`` says where the row holds the key columns.

        Keys are hashed in the table's types, so that equal keys share a bucket whatever type the
        source gives them.
        """
        named = columns or {}
        return bucket_of(self.buckets, [F.col(named.get(key, key)).cast(self.schema[key].dataType) for key in self.keys])

    def _reached(self, operation: Operation, spark: SparkSession) -> tuple[set[str], Column] | None:
        mapping = {theirs: mine for mine, theirs in operation.mapping.items()}
        if isinstance(operation, Merge) and operation.mirror:
            found = [] if operation.source.isEmpty() else list(range(self.buckets))
        else:
            # At most as many numbers as there are buckets.
            sent = operation.source.select(self.bucket_of(mapping).alias(BUCKET)).distinct()
            found = [row[BUCKET] for row in sent.where(F.col(BUCKET).isNotNull()).collect()]
        return ({f"{BUCKET}={n}" for n in found}, F.col(BUCKET).isin(found)) if found else None

    def _require(self, operation: Operation, spark: SparkSession) -> None:
        super()._require(operation, spark)
        match = operation.choices.match or operation.spec.keys
        plain_insert = isinstance(operation, Insert) and not operation.choices.insert_if_missing
        if plain_insert or not set(self.keys) <= {operation.mapping.get(n, n) for n in match}:
            raise ConfigurationError(f"a bucketed table takes changes matched on {', '.join(self.keys)}")
        rekeys = isinstance(operation, (Update, Merge)) and set(operation.choices.update or ()) & set(self.keys)
        if rekeys:
            raise ConfigurationError("an update must not move rows between buckets")
        if operation.collation is not None:
            raise ConfigurationError("buckets hash keys as they are, so keys cannot be collated")
