"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import jaccard, mixing, repeats, toxicity
from rowtide.llm.common import id_hash
from rowtide.llm.queries import packed, table
from rowtide.session import fresh_folder, frozen

AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Ids that may be broadcast, 8 MB of them.
BROADCAST_IDS = 1_000_000
#: Rows that go to a Python worker at once. Of long texts, Spark's 10,000 are a whole input split, held by engine and worker.
ROWS_AT_ONCE = 1000


def few_at_once(stage: Callable) -> Callable:
    """``stage`` in a session that hands its workers at most ROWS_AT_ONCE rows at once; the rows that come out are the same."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # The stage's frame runs later, so the setting stays.
        if not 0 < int(spark.conf.get(AT_ONCE)) <= ROWS_AT_ONCE:
            spark.conf.set(AT_ONCE, ROWS_AT_ONCE)
        return stage(spark, docs, sf_dir)

    return run


@few_at_once
def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity, learned from the labels of four folds of five.

    Rows keep their columns. Texts that are null or without words stay; repeated rows are scored each.
    """
    labels = table(spark, sf_dir, "labels").where(id_hash("doc_id", 5) != 0)
    network = toxicity.learned(table(spark, sf_dir, "documents"), labels)
    return toxicity.kept(docs.select(*COLUMNS), network, below=0.5)


@few_at_once
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the smallest id, and of its rows the smallest text hash.

    Rows, not ids, are near copies, stay or go: of rows that repeat id and text one stays, and a row stays
    whatever becomes of other texts under its id. Rows without id or words stay.
    """
    folder = fresh_folder(spark, "numbered")
    docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    named = rows.where(F.col("doc_id").isNotNull())
    found = jaccard.jaccard_components(named.select("_row", "text"), "_row").where("n_shingles > 0")
    member = found.select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct("doc_id", F.xxhash64("text").alias("hash"), "_row")
    first = named.select("_row", order.alias("_order")).join(member, "_row").groupBy("component_id").agg(F.min("_order").alias("_first"))
    dropped = frozen(member.select("_row").join(first.select("_first._row"), "_row", "left_anti"))
    few = dropped.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(dropped) if few else dropped, "_row", "left_anti").select(*COLUMNS)


@few_at_once
def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 bytes or more that documents with smaller ids have.

    A character of which a byte goes goes with it. No row goes; ``n_chars`` counts what is left of the text, and
    a null text stays null.
    """
    cut = repeats.remove_repeats(docs.select(*COLUMNS), carry=("lang", "source"), as_text=True)
    text = cut.select("doc_id", F.col("kept").alias("text"), "lang", "source")
    return text.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, by the Poisson counts of their sources' target weights."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


@few_at_once
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of 2048, by piece."""
    return packed(docs)


STAGES = [
    ("toxicity", clean),
    ("jaccard join", one_of_each),
    ("suffix-array dedup", unrepeated),
    ("mixing", mixed),
    ("packing", packing),
]

#: A trained network and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES:
        folder = fresh_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
