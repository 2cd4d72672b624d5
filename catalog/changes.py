"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import fixtures as fx
from rowtide import TableSpec, delete, insert, merge, update
from rowtide.functions.enums import decode_enums, encode_enums
from rowtide.functions.types import spark_type
from rowtide.operators import constraints, duplicates
from rowtide.operators.chain import Chain
from rowtide.operators.identity import with_ordinal
from rowtide.session import fresh_folder
from rowtide.sources.buckets import BucketedTable
from rowtide.sources.partitions import PartitionedTable
from rowtide.sources.tables import sorted_by_keys
from rowtide.streaming.upsert import apply_stream

STATUS_CODES = {"F": 0, "O": 1, "P": 2}
NO_PRIORITY = replace(fx.ORDERS, defaults={"o_orderpriority": "'NONE'"})
VERSIONED = TableSpec("orders", keys=("o_orderkey",), row_version="ver")


# Append

def bulk_append(spark: SparkSession, sf: str) -> DataFrame:
    return insert(fx.on_file(spark, sf), fx.first_time(spark, sf), fx.ORDERS).plan().snapshot


def append_subset_defaults(spark: SparkSession, sf: str) -> DataFrame:
    listed = insert(fx.on_file(spark, sf), fx.first_time(spark, sf), NO_PRIORITY)
    return listed.columns("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "ver").plan().snapshot


def append_null_defaults(spark: SparkSession, sf: str) -> DataFrame:
    spec = replace(fx.ORDERS, defaults={"o_totalprice": "0.0D"})
    priced = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    source = fx.first_time(spark, sf).withColumn("o_totalprice", priced)
    return insert(fx.on_file(spark, sf), source, spec).nulls_take_defaults().plan().snapshot


def typed_append(spark: SparkSession, sf: str) -> DataFrame:
    stored = fx.on_file(spark, sf).withColumns({
        "o_orderkey": F.col("o_orderkey").cast(spark_type("int")),
        "o_totalprice": F.col("o_totalprice").cast(spark_type("decimal", 18, 2)),
    })
    grown = insert(stored, fx.first_time(spark, sf), fx.ORDERS).plan().snapshot
    return grown.withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


def enum_codes(spark: SparkSession, sf: str) -> DataFrame:
    spec = replace(fx.ORDERS, enums={"o_orderstatus": STATUS_CODES})
    stored = encode_enums(fx.on_file(spark, sf), spec)
    grown = insert(stored, encode_enums(fx.first_time(spark, sf), spec), spec).plan().snapshot
    coded = grown.select("o_orderkey", F.col("o_orderstatus").alias("status_code"), "o_orderstatus")
    return decode_enums(coded, spec)


def computed_column(spark: SparkSession, sf: str) -> DataFrame:
    spec = replace(fx.ORDERS, computed={"half_price": "o_totalprice * 0.5D"})
    stored = fx.on_file(spark, sf).withColumn("half_price", F.col("o_totalprice") * 0.5)
    return update(stored, fx.feed(spark, sf), spec).check_token(False).plan().snapshot


def computed_on_insert(spark: SparkSession, sf: str) -> DataFrame:
    """A computed column that is stored out of date, and one that is not stored."""
    spec = replace(fx.ORDERS, computed={"half_price": "o_totalprice * 0.5D", "paid": "o_totalprice + 1"})
    outdated = fx.on_file(spark, sf).withColumn("half_price", F.lit(0.0))
    return insert(outdated, fx.first_time(spark, sf), spec).plan().snapshot


def computed_on_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same under a merge that only inserts."""
    spec = replace(fx.ORDERS, computed={"half_price": "o_totalprice * 0.5D", "paid": "o_totalprice + 1"})
    outdated = fx.on_file(spark, sf).withColumn("half_price", F.lit(0.0))
    return merge(outdated, fx.first_time(spark, sf), spec).update_columns().plan().snapshot


def merge_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Pending orders of the feed lose their key; each is a row of its own."""
    keyed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    source = fx.feed(spark, sf).withColumn("o_orderkey", keyed)
    merged = merge(fx.on_file(spark, sf), source, TableSpec("orders")).match_on("o_orderkey").sequence("seq")
    return merged.ignore_null_keys().plan().snapshot


def insert_if_missing(spark: SparkSession, sf: str) -> DataFrame:
    return insert(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).if_missing().plan().snapshot


def insert_if_missing_output(spark: SparkSession, sf: str) -> DataFrame:
    added = insert(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).if_missing()
    return added.ordinal("seq").output("o_orderkey").plan().changes.select("o_orderkey", "action")


def insert_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Feed rows of pending orders lose their key; they match nothing and are added."""
    keyed = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    source = fx.feed(spark, sf).withColumn("o_orderkey", keyed)
    added = insert(fx.on_file(spark, sf), source, TableSpec("orders")).if_missing("o_orderkey")
    return added.ignore_null_keys().plan().snapshot


def insert_identity(spark: SparkSession, sf: str) -> DataFrame:
    parts = fx.table(spark, sf, "part")
    return insert(parts, fx.reissued_parts(spark, sf), fx.PARTS).sequence("origin").plan().snapshot


def insert_output(spark: SparkSession, sf: str) -> DataFrame:
    parts = fx.table(spark, sf, "part")
    added = insert(parts, fx.reissued_parts(spark, sf), fx.PARTS).sequence("origin").output_generated()
    return added.plan().changes


def insert_keep_identity(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.reissued_parts(spark, sf).withColumn("p_partkey", F.col("origin") + 1_000_000_000)
    return insert(fx.table(spark, sf, "part"), source, fx.PARTS).keep_identity().plan().snapshot


# Update

def update_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return update(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).check_token(False).plan().snapshot


def update_subset(spark: SparkSession, sf: str) -> DataFrame:
    changed = update(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).check_token(False)
    return changed.update_columns("o_orderpriority").plan().snapshot


def update_natural_key(spark: SparkSession, sf: str) -> DataFrame:
    changed = update(fx.table(spark, sf, "part"), fx.rebranding(spark, sf), fx.PARTS)
    return changed.match_on("p_name").update_columns("p_brand").sequence("seq").plan().snapshot


def mapped_update(spark: SparkSession, sf: str) -> DataFrame:
    names = {"id": "o_orderkey", "price": "o_totalprice", "urgency": "o_orderpriority"}
    source = fx.feed(spark, sf).select(*(F.col(theirs).alias(mine) for mine, theirs in names.items()))
    return update(fx.on_file(spark, sf), source, fx.ORDERS).rename(names).plan().snapshot


def update_token_checked(spark: SparkSession, sf: str) -> DataFrame:
    return update(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).plan().snapshot


def update_output(spark: SparkSession, sf: str) -> DataFrame:
    changed = update(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).ordinal("seq")
    return changed.output("o_totalprice", "o_orderpriority").plan().changes


def collated_update(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer, found by name whatever its case."""
    standing = F.when(F.col("c_acctbal") < 0, "OVERDRAWN").otherwise("IN CREDIT").alias("c_mktsegment")
    source = fx.table(spark, sf, "customer").select(F.upper("c_name").alias("c_name"), standing)
    changed = update(fx.table(spark, sf, "customer"), source, fx.CUSTOMERS).match_on("c_name")
    return changed.update_columns("c_mktsegment").collate_keys("UTF8_LCASE").plan().snapshot


# Delete

def delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return delete(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).check_token(False).plan().snapshot


def delete_slim_source(spark: SparkSession, sf: str) -> DataFrame:
    customers = fx.table(spark, sf, "customer")
    overdrawn = fx.table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select("c_name")
    return delete(customers, overdrawn, fx.CUSTOMERS).match_on("c_name").plan().snapshot


def delete_rows_removed(spark: SparkSession, sf: str) -> DataFrame:
    gone = delete(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).check_token(False).plan()
    return gone.removed_rows.select("o_orderkey")


def delete_token_checked(spark: SparkSession, sf: str) -> DataFrame:
    return delete(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).plan().snapshot


# Merge

def _merge(spark: SparkSession, sf: str, spec: TableSpec = fx.ORDERS):
    return merge(fx.on_file(spark, sf), fx.feed(spark, sf), spec).sequence("seq", distinct_per_key=True)


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).check_token(False).plan().snapshot


def merge_mirror(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).check_token(False).delete_unmatched().plan().snapshot


def merge_actions(spark: SparkSession, sf: str) -> DataFrame:
    mirrored = _merge(spark, sf).check_token(False).delete_unmatched().plan()
    return mirrored.changes.select("o_orderkey", "action")


def merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).check_token(False).delete_unmatched().plan().counts


def merge_token_checked(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).plan().snapshot


def merge_insert_columns(spark: SparkSession, sf: str) -> DataFrame:
    chosen = _merge(spark, sf, NO_PRIORITY).check_token(False)
    return chosen.insert_columns("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "ver").plan().snapshot


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).update_columns().plan().snapshot


def merge_dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.feed_with_repeats(spark, sf)
    return merge(fx.on_file(spark, sf), source, fx.ORDERS).sequence("seq").check_token(False).plan().snapshot


def merge_insert_identity(spark: SparkSession, sf: str) -> DataFrame:
    """A merge on a name that many parts share; new names get new ids."""
    source = with_ordinal(fx.renamed_parts(spark, sf), "origin")
    return merge(fx.table(spark, sf, "part"), source, fx.PARTS).match_on("p_name").plan().snapshot


def merge_empty_source(spark: SparkSession, sf: str) -> DataFrame:
    cancelled = fx.feed(spark, sf).where(F.col("o_orderstatus") == "CANCELLED")  # no order is
    emptied = merge(fx.on_file(spark, sf), cancelled, fx.ORDERS).sequence("seq")
    return emptied.check_token(False).delete_unmatched().plan().snapshot


def merge_output(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merge(spark, sf).check_token(False).ordinal("seq").output("o_totalprice", "o_orderpriority")
    return merged.plan().changes


def write_back(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merge(spark, sf, VERSIONED).ordinal("seq").output_generated().plan()
    return merged.write_back().select("o_orderkey", "seq", "ver")


def row_version_bump(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf, VERSIONED).plan().snapshot


# Checks and layout

def dedup_last(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.keep_last(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return duplicates.duplicate_keys(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def unique_violations(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.feed(spark, sf)
    grown = insert(fx.on_file(spark, sf), source, fx.ORDERS).plan()
    return constraints.unique_violations(grown.snapshot, source, ["o_orderkey"])


def constraint_rejects(spark: SparkSession, sf: str) -> DataFrame:
    spec = TableSpec("part", keys=("p_partkey",), required=frozenset({"p_name"}), max_length={"p_name": 10})
    named = F.when(F.col("p_size") != 7, F.col("p_name"))
    source = fx.table(spark, sf, "part").select("p_partkey", named.alias("p_name"))
    return constraints.constraint_rejects(source, spec)


def stale_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _merge(spark, sf).plan().stale.select("o_orderkey", "ver")


def unmatched_source(spark: SparkSession, sf: str) -> DataFrame:
    return update(fx.on_file(spark, sf), fx.feed(spark, sf), fx.ORDERS).plan().unmatched.select("o_orderkey")


def op_chain(spark: SparkSession, sf: str) -> DataFrame:
    finished = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    steps = Chain(fx.on_file(spark, sf))
    steps.then(insert(None, fx.first_time(spark, sf), fx.ORDERS))
    steps.then(update(None, fx.feed(spark, sf), fx.ORDERS).check_token(False))
    steps.then(delete(None, finished, fx.ORDERS))
    return steps.snapshot


def ordered_key_layout(spark: SparkSession, sf: str) -> DataFrame:
    return sorted_by_keys(_merge(spark, sf).check_token(False).plan().snapshot, ["o_orderkey"])


def bucketed_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert on a stored table in buckets, of which only those the feed reaches are rewritten."""
    on_file = fx.on_file(spark, sf)
    folder = fresh_folder(spark, "bucketed-merge")
    stored = BucketedTable(f"{folder}/table", on_file.schema, ("o_orderkey",), buckets=8)
    stored.create(on_file)
    stored.apply(_merge(spark, sf).check_token(False), f"{folder}/staging")
    return stored.read(spark)


def partitioned_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The upsert on a table stored by priority, which the feed changes: its rows move to other partitions."""
    on_file = fx.on_file(spark, sf)
    folder = fresh_folder(spark, "partitioned-merge")
    stored = PartitionedTable(f"{folder}/table", on_file.schema, ("o_orderpriority",))
    stored.create(on_file)
    stored.apply(_merge(spark, sf).check_token(False), f"{folder}/staging")
    return stored.read(spark)


def _catalog_commit(spark: SparkSession, sf: str, define) -> DataFrame:
    """The upsert committed to a catalog table, and then again, which changes nothing more."""
    folder = fresh_folder(spark, "catalog-commit")
    spec = replace(fx.ORDERS, name=f"orders_{folder.rpartition('-')[2]}")
    define(fx.on_file(spark, sf).write.format("parquet").option("path", f"{folder}/first")).saveAsTable(spec.name)
    for attempt in ("second", "third"):
        merged = merge(None, fx.feed(spark, sf), spec).sequence("seq", distinct_per_key=True)
        merged.check_token(False).commit(f"{folder}/{attempt}")
    return spark.table(spec.name)


def catalog_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A commit to a table with partitions."""
    return _catalog_commit(spark, sf, lambda writer: writer.partitionBy("o_orderstatus", "o_orderpriority"))


def catalog_commit_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """A commit to a table with buckets inside of its partitions."""
    return _catalog_commit(
        spark, sf, lambda writer: writer.partitionBy("o_orderstatus").bucketBy(4, "o_orderkey").sortBy("o_orderkey")
    )


def catalog_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A partial insert into a catalog table that declares a default of its own."""
    folder = fresh_folder(spark, "catalog-defaults")
    name = f"orders_{folder.rpartition('-')[2]}"
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" + (" DEFAULT 'NONE'" if f.name == "o_orderpriority" else "")
        for f in fx.on_file(spark, sf).schema
    )
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{folder}/table'")
    fx.on_file(spark, sf).write.insertInto(name)
    listed = insert(None, fx.first_time(spark, sf), replace(fx.ORDERS, name=name))
    listed.columns("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "ver").append()
    return spark.table(name)


def chain_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of three steps that are written in one job."""
    folder = fresh_folder(spark, "chain-counts")
    finished = fx.table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    steps = Chain(fx.on_file(spark, sf))
    steps.then(delete(None, finished, fx.ORDERS))
    steps.then(_merge(spark, sf).check_token(False))
    steps.then(delete(None, finished, fx.ORDERS))
    counts = steps.save(f"{folder}/table")
    rows = [(n, *c) for n, c in enumerate(counts)]
    return spark.createDataFrame(rows, "step int, inserted long, updated long, deleted long, total_affected long")


def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What the change sets of a stream of events tell: each user, added once."""
    folder, _ = _latest_events(spark, sf, told=True)
    return spark.read.parquet(f"{folder}/changes").select("user_id", "action", "event_id")


def stream_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The events upserted by user through a stream; the last event of a user stays."""
    _, latest = _latest_events(spark, sf)
    return latest.read(spark)


def _latest_events(spark: SparkSession, sf: str, told: bool = False) -> tuple[str, BucketedTable]:
    fields = fx.table(spark, sf, "events").select("user_id", "event_id", "event_type", "value").schema
    spec = TableSpec("latest_event", keys=("user_id",))
    folder = fresh_folder(spark, "stream-merge")
    latest = BucketedTable(f"{folder}/table", T.StructType(fields.fields), ("user_id",), buckets=8)
    stream = (
        spark.readStream.schema(fx.table(spark, sf, "events").schema)
        .parquet(f"{sf}/events.parquet*")  # as a pattern it may name a file or a folder
        .select("user_id", "event_id", "event_type", "value")
    )

    def upsert(batch: DataFrame):
        merged = merge(None, batch, spec).sequence("event_id", distinct_per_key=True)
        return merged.ordinal("event_id").output("event_id") if told else merged

    started = apply_stream(
        stream, latest, upsert, checkpoint=f"{folder}/progress", staging=f"{folder}/staging",
        changes=f"{folder}/changes" if told else None,
    )
    started.awaitTermination()
    return folder, latest


QUERIES = {
    query.__name__: query
    for query in (
        bulk_append, append_subset_defaults, append_null_defaults, typed_append, enum_codes, computed_column,
        computed_on_insert, computed_on_merge, merge_null_keys,
        insert_if_missing, insert_if_missing_output, insert_null_keys, insert_identity, insert_output, insert_keep_identity,
        update_by_key, update_subset, update_natural_key, mapped_update, update_token_checked, update_output,
        collated_update,
        delete_by_key, delete_slim_source, delete_rows_removed, delete_token_checked,
        merge_upsert, merge_mirror, merge_actions, merge_counts, merge_token_checked, merge_insert_columns,
        merge_insert_only, merge_dedup_last, merge_insert_identity, merge_empty_source,
        merge_output, write_back, row_version_bump,
        dedup_last, duplicate_keys, unique_violations, constraint_rejects, stale_rows, unmatched_source,
        op_chain, chain_counts, ordered_key_layout, bucketed_merge, partitioned_merge, catalog_commit, catalog_commit_buckets,
        catalog_defaults, stream_merge, stream_changes,
    )
}
