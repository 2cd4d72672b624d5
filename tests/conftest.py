from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowtide import TableSpec, column  # noqa: E402

BOOK_FIELDS = T.StructType([
    column("id", T.IntegerType(), key=True, identity=True),
    column("isbn", T.StringType(), False, max_length=20),
    column("title", T.StringType(), False, max_length=200),
    column("price", T.DecimalType(18, 2), False),
    column("edition", T.IntegerType(), False, default="1"),
    column("shelf", T.StringType(), computed="concat(isbn, '/', edition)"),
    column("row_version", T.LongType(), rowversion=True),
])
BOOKS = TableSpec.from_schema("book", BOOK_FIELDS, table="books", unique=[("isbn",)])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "2")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def _book(number: int, isbn: str, title: str, price, edition: int, version: int):
    return (number, isbn, title, Decimal(price), edition, f"{isbn}/{edition}", version)


@pytest.fixture
def books(spark):
    """``books("M", 2)`` is a table of M0001 and M0002, priced 1 and 2, ids from 1, versions from 1."""

    def make(prefix: str = "M", count: int = 0):
        rows = [_book(n, f"{prefix}{n:04d}", f"Title {n}", n, 1, n) for n in range(1, count + 1)]
        fields = T.StructType([T.StructField(f.name, f.dataType) for f in BOOK_FIELDS])
        return spark.createDataFrame(rows, fields)

    return make


@pytest.fixture
def sent(spark):
    """A source of ``(isbn, title, price, edition)`` rows with their position in ``n``."""

    def make(*rows, **extra):
        full = [(*row[:2], Decimal(row[2]), *(row[3:] or (1,)), n) for n, row in enumerate(rows)]
        return spark.createDataFrame(
            full, "isbn string, title string, price decimal(18,2), edition int, n long"
        )

    return make


def by_isbn(df, *names):
    """Rows as a dict from isbn to the named values."""
    return {row["isbn"]: tuple(row[n] for n in names) if len(names) > 1 else row[names[0]] for row in df.collect()}
