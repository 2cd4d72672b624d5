"""Targets and change feeds, taken from the driver's tables.

The orders table is cut by date, the way an incremental load meets it: what is already on file
(before 2000) and a feed that sends 1999 again with corrections and everything since for the first
time. The two cover every order. ``FIXTURE_SQL`` says the same for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowtide import TableSpec

# Schemas read from the files once; a further read of the table then starts no job.
_SCHEMAS: dict[str, StructType] = {}

ORDERS = TableSpec("orders", keys=("o_orderkey",), token="ver")
PARTS = TableSpec("part", keys=("p_partkey",), identity="p_partkey")
CUSTOMERS = TableSpec("customer", keys=("c_custkey",), unique=(("c_name",),))

FIXTURE_SQL = """
WITH ord_t AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_custkey % 5 AS ver
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
), ord_s AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice,
         'CHANGED' AS o_orderpriority, o_custkey % 3 AS ver, o_orderkey AS seq
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00'
), ord_new AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_custkey % 5 AS ver
  FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
), ord_d AS (
  SELECT * FROM ord_s UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, 'LAST', o_custkey % 3, o_orderkey + 1000000000
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01 00:00:00' AND o_orderpriority = '1-URGENT'
), part_s AS (
  SELECT p_name, min(p_partkey) AS seq, 'NK' AS p_brand FROM part GROUP BY p_name
), part_new AS (
  SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position, p_partkey AS origin, p_name, p_brand,
         p_type, p_size, p_retailprice
  FROM part
), part_m AS (
  SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS position, p_partkey AS origin,
         CASE WHEN p_brand = 'Brand#1' THEN p_name ELSE p_name || ' by ' || p_brand END AS p_name,
         'NEW' AS p_brand, p_type, p_size, p_retailprice
  FROM part
)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def on_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before 2000, with a token."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < _day("2000-01-01"))
    return _with_token(orders)


def first_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since 2000, in the shape of the table."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= _day("2000-01-01"))
    return _with_token(orders)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders since 1999 with changed values and a token that is often out of date."""
    return _feed(_since_1999(spark, sf_dir), 1, "CHANGED", 0)


def feed_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed, with a second and later version of every urgent order."""
    urgent = _since_1999(spark, sf_dir).where(F.col("o_orderpriority") == "1-URGENT")
    return feed(spark, sf_dir).unionByName(_feed(urgent, 2, "LAST", 1_000_000_000))


def rebranding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new brand for every part name; a name belongs to many parts."""
    return table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("seq"), F.lit("NK").alias("p_brand"))


def reissued_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, to be added again under a new id, in the order of the old ones."""
    return table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "origin")


def renamed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a feed that names it with its brand, save those of the first brand."""
    branded = F.concat_ws(" by ", "p_name", "p_brand")
    named = F.when(F.col("p_brand") == "Brand#1", F.col("p_name")).otherwise(branded)
    parts = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "origin")
    return parts.withColumns({"p_name": named, "p_brand": F.lit("NEW")})


def _since_1999(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= _day("1999-01-01"))


def _day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _with_token(orders: DataFrame) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        (F.col("o_custkey") % 5).alias("ver"),
    )


def _feed(orders: DataFrame, raise_by: int, priority: str, later: int) -> DataFrame:
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        (F.col("o_totalprice") + raise_by).alias("o_totalprice"),
        F.lit(priority).alias("o_orderpriority"),
        (F.col("o_custkey") % 3).alias("ver"),
        (F.col("o_orderkey") + later).alias("seq"),
    )
