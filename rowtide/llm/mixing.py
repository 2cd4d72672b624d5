"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rate above this is drawn as a sum of draws of this rate and one of the rest: exp(-rate) stays a normal double.
CHUNK = 500.0
#: Sources whose rates may be broadcast; a row of rates has at most 1,000 doubles.
BROADCAST_SOURCES = 2000
ADDED = ("copy", "repeats", "shuffle_key")


def hex_number(text: Column, digits: int) -> Column:
    """The first hex digits of the md5 of a text, as a long."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) of 52 bits from the parts' md5."""
    return hex_number(F.concat_ws("#", *parts), 13) / F.lit(float(2**52))


def cumulative(rate: Column) -> Column:
    """P(count <= k) of a Poisson count for k = 0, 1, ... until the tail is below any 52-bit uniform."""
    last = (rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step)["sums"]


def drawn(sums: Column, u: Column) -> Column:
    """The inverse: how many of the cumulative probabilities the uniform reaches."""
    return F.size(F.filter(sums, lambda p: p <= u))


def mix(
    docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5, epochs: float = 1.0,
    seed: int = 17, id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """``docs`` with each row repeated by a Poisson count whose mean brings its source to its target weight.

    A source's rate is ``weight * epochs * rows / rows of the source``. ``weights`` gives the sources'
    shares of the result (others get none; they are scaled to 1); without it a source weighs its row
    count to the power of ``temperature``. A row's count inverts the Poisson distribution at a uniform
    hash of its id, so it is the same in every run; a count of zero leaves the row out, which is the
    method. Adds ``copy long`` (from 1), ``repeats long`` and ``shuffle_key long``; copies are dealt
    over partitions and ordered by that hash of id and copy.

    A null source is a source; a null id hashes as an empty text. Repeated rows of an id get its count
    each. Other columns stay; input columns named as the three added ones are replaced. An empty table
    gives no rows. Texts are not looked at.
    """
    source, doc_id = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    # The row as one value: its columns may have any names.
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in ADDED)).alias("_row"), source.alias("_of"),
        F.coalesce(doc_id.cast("string"), F.lit("")).alias("_key"),
    )
    counts = docs.groupBy(source.alias("_source")).agg(F.count(F.lit(1)).cast("double").alias("_rows"))
    if weights is None:
        wanted = F.pow("_rows", F.lit(temperature))
    else:
        wanted = F.lit(0.0)
        for name, weight in weights.items():
            wanted = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(wanted)
    weighed = counts.withColumn("_weight", wanted)
    whole = weighed.agg(F.sum("_rows").alias("_all_rows"), F.sum("_weight").alias("_all_weight"))
    rate = F.col("_weight") / F.col("_all_weight") * epochs * F.col("_all_rows") / F.col("_rows")
    rates = (
        weighed.crossJoin(F.broadcast(whole)).where("_weight > 0").select("_source", rate.alias("_rate"))
        .withColumn("_chunks", F.floor(F.col("_rate") / CHUNK))
        .withColumn("_sums", cumulative(F.col("_rate") - F.col("_chunks") * CHUNK))
        .withColumn("_chunk_sums", F.when(F.col("_chunks") > 0, cumulative(F.lit(CHUNK))))
    )
    if counts.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rated = rows.join(F.broadcast(rates), F.col("_of").eqNullSafe(F.col("_source")))
    else:
        # Many sources: join by source and a salt, so that a large source is spread over tasks.
        salts = 64
        salted = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
        dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("_key"), F.lit(salts)))
        rated = dealt.join(salted, F.col("_of").eqNullSafe(F.col("_source")) & (F.col("_deal") == F.col("_salt")))
    key = F.col("_key")
    chunks = F.aggregate(
        F.sequence(F.lit(1), F.col("_chunks").cast("int")), F.lit(0),
        lambda total, j: total + drawn(F.col("_chunk_sums"), uniform(key, F.lit(str(seed)), j.cast("string"))),
    )
    repeats = drawn(F.col("_sums"), uniform(key, F.lit(str(seed)))) + F.when(F.col("_chunks") > 0, chunks).otherwise(0)
    copies = (
        rated.withColumn("repeats", repeats.cast("long")).where("repeats > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats"))))
        .withColumn("shuffle_key", hex_number(F.concat_ws("#", key, F.lit(f"{seed}"), F.lit("copy"), F.col("copy").cast("string")), 15))
    )
    kept = copies.select("_row.*", *ADDED)
    return kept.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


#: The same over the rows of ``{docs}`` in SQL, for rates up to CHUNK; ``{columns}`` are the kept columns.
MIX_SQL = """
WITH RECURSIVE counts AS (
  SELECT source, count(*)::DOUBLE AS n FROM {docs} GROUP BY source
), rates AS (
  SELECT source, pow(n, 0.5) / (SELECT sum(pow(n, 0.5)) FROM counts) * 1.0 * (SELECT sum(n) FROM counts) / n AS rate
  FROM counts
), poisson AS (
  SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS reached FROM rates
  UNION ALL
  SELECT source, rate, k + 1, p * rate / (k + 1), reached + p * rate / (k + 1)
  FROM poisson WHERE k < floor(rate + 12 * sqrt(rate) + 30)
), draws AS (
  SELECT d.*, ('0x' || md5(coalesce(doc_id::VARCHAR, '') || '#17')[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM {docs} d
), repeated AS (
  SELECT {columns}, (SELECT count(*) FROM poisson p WHERE p.source IS NOT DISTINCT FROM d.source AND p.reached <= d.u) AS repeats
  FROM draws d
)
SELECT {columns}, copy, repeats,
  ('0x' || md5(coalesce(doc_id::VARCHAR, '') || '#17#copy#' || copy)[1:15])::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, repeats + 1)) AS copy FROM repeated WHERE repeats > 0)
"""
