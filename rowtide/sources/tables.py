"""Reading a target table and writing its next snapshot."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import ConfigurationError, ExecutionError
from rowtide.sources.files import joined, listed
from rowtide.spec import TableSpec

_INPUT_PART = "__input_part"
BUCKET = "bucket"


def bucket_of(buckets: int, keys: Sequence[Column]) -> Column:
    """The number of the bucket that a key falls into."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# Fixed value: the folder of rows whose partition column is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Clusters(NamedTuple):
    """The hash buckets of a catalog table."""

    count: int
    columns: tuple[str, ...]
    sort: tuple[str, ...]


@dataclass(frozen=True)
class Layout:
    """How a snapshot lies in its files.

    ``sort_by`` range-partitions and sorts by the given columns, so that the minimum and maximum of
    a key in each file let later reads skip files. ``rows_per_file`` is the batch size of the load.
    ``partition_by`` makes folders of column values, ``buckets`` folders of a hash of ``bucket_by``; ``clusters``
    are the buckets within files that Spark's catalog knows.
    """

    sort_by: tuple[str, ...] = ()
    rows_per_file: int | None = None
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    clusters: Clusters | None = None

    def __post_init__(self):
        if self.rows_per_file is not None and self.rows_per_file <= 0:
            raise ConfigurationError("the batch size must be positive")

    def arranged(self, rows: DataFrame) -> DataFrame:
        """``rows`` where they are to be written from. Partitions are spread over several files if they are large."""
        if self.buckets:
            rows = rows.withColumn(BUCKET, bucket_of(self.buckets, [F.col(name) for name in self.bucket_by]))
        if self.sort_by:
            return sorted_by_keys(rows, self.sort_by)
        if self.clusters:
            return rows.repartition(self.clusters.count, *self.clusters.columns)
        return rows.hint("rebalance", *self.folders) if self.folders else rows

    def stored_columns(self, columns: Sequence[str]) -> list[str]:
        """What a row of ``columns`` is written with."""
        return [*columns, BUCKET] if self.buckets else list(columns)

    def stored_schema(self, fields: T.StructType) -> T.StructType:
        """The schema of the files."""
        return T.StructType([*fields, T.StructField(BUCKET, T.IntegerType())]) if self.buckets else fields

    @property
    def folders(self) -> tuple[str, ...]:
        """The columns whose values name the folders."""
        return (BUCKET,) if self.buckets else self.partition_by


def qualified(spec: TableSpec, table: str | None = None, schema: str | None = None) -> str:
    """The catalog name of the spec's table, or of the one that takes its place."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in (schema or spec.schema, table or spec.name))


def read_table(spark: SparkSession, spec: TableSpec, table: str | None = None, schema: str | None = None) -> DataFrame:
    """The spec's table from the catalog, or the one that takes its place."""
    name = qualified(spec, table, schema)
    try:
        return spark.table(name)
    except AnalysisException as error:
        raise ExecutionError(f"cannot read {name}: {error}") from error


def laid_out_as(spark: SparkSession, table: str, layout: Layout) -> Layout:
    """``layout`` with the partitions and buckets that a catalog table has."""
    known = _described(spark, table)
    own = replace(layout, partition_by=tuple(_strings(known.partitionColumnNames())))
    if not known.bucketSpec().isDefined():
        return own
    if layout.sort_by:
        raise ConfigurationError(f"{table} is bucketed, which decides on the order of its files: leave out ordered")
    spec = known.bucketSpec().get()
    sort = tuple(_strings(spec.sortColumnNames()))
    return replace(own, clusters=Clusters(spec.numBuckets(), tuple(_strings(spec.bucketColumnNames())), sort))


def point_to(spark: SparkSession, table: str, path: str) -> None:
    """Let a catalog table read from ``path`` from now on, each of its partitions from the folder there.

    A table without partitions changes in one step. Partitions change one by one, those that are gone last; the call
    can be repeated.
    """
    partitions = list(_strings(_described(spark, table).partitionColumnNames()))
    if partitions:
        _move_partitions(spark, table, path, partitions)
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(table)


def _move_partitions(spark: SparkSession, table: str, path: str, columns: Sequence[str]) -> None:
    found = subfolders(spark, path, len(columns))
    known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for name in found:
        location = _quoted(joined(path, name))
        if name in known:
            spark.sql(f"ALTER TABLE {table} {_partition(spark, name)} SET LOCATION {location}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_partition(spark, name)} LOCATION {location}")
    for name in sorted(known - set(found)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_partition(spark, name)}")


def _partition(spark: SparkSession, name: str) -> str:
    """The clause for a partition, from the name of its folder."""
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    values = []
    for part in name.split("/"):
        column, _, value = part.partition("=")
        shown = "null" if value == NULL_FOLDER else _quoted(plain(value))
        values.append(f"`{plain(column).replace('`', '``')}` = {shown}")
    return f"PARTITION ({', '.join(values)})"


def _described(spark: SparkSession, table: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(table))


def _strings(found) -> list[str]:
    return [found.apply(n) for n in range(found.size())]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sorted_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` in contiguous key ranges, sorted within each.

    The input partition number takes part in the ranges, so a key that owns a large share of the
    rows, identical copies included, spreads over neighbouring output partitions.
    """
    numbered = df.withColumn(_INPUT_PART, F.spark_partition_id())
    ranged = numbered.repartitionByRange(*keys, _INPUT_PART)
    return ranged.sortWithinPartitions(*keys).drop(_INPUT_PART)


def write_table(snapshot: DataFrame, name: str, keys: Sequence[str], buckets: int, layout: Layout) -> None:
    """Write a snapshot as a new catalog table, bucketed and sorted by ``keys``.

    Later operations that match on ``keys`` join the table where it lies, without a shuffle or sort
    of its own; only the source moves. Meant for keys that are unique, as a bucket cannot split one.
    """
    rows = snapshot.repartition(buckets, *keys)
    writer = rows.write.mode("errorifexists").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if layout.rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", layout.rows_per_file)
    writer.saveAsTable(name)


def write_rows(rows: DataFrame, path: str, layout: Layout, mode: str) -> None:
    """Write ``rows``, which ``layout`` has arranged, as Parquet."""
    writer = rows.write.mode(mode)
    if layout.rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", layout.rows_per_file)
    if layout.folders:
        writer = writer.partitionBy(*layout.folders)
    if layout.clusters is None:
        writer.parquet(path)
        return
    # Only tables are written in buckets; this one is dropped again, and its files stay.
    draft = f"rowtide_draft_{uuid.uuid4().hex}"
    bucketed = writer.format("parquet").bucketBy(layout.clusters.count, *layout.clusters.columns)
    if layout.clusters.sort:
        bucketed = bucketed.sortBy(*layout.clusters.sort)
    try:
        bucketed.option("path", path).saveAsTable(draft)
    finally:
        rows.sparkSession.sql(f"DROP TABLE IF EXISTS {draft}")


def subfolders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """The folders ``depth`` levels below ``path``, as paths from there."""
    names = [""]
    for _ in range(depth):
        names = [
            f"{name}/{below}".lstrip("/") for name in names for below in listed(spark, joined(path, name) if name else path)
        ]
    return sorted(names)
