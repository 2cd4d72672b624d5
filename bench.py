"""Headline change operations at one scale, each written in full to a sink that discards rows.

All queries run once to warm up, then each counts with the median of three. Prints one JSON line. ``ms_per_10k_rows`` divides
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import fixtures as fx  # noqa: E402
from catalog.changes import QUERIES  # noqa: E402
from rowtide import insert  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3



def append_new_rows(spark: SparkSession, sf: str):
    """What a plain insert writes: the new rows alone."""
    return insert(fx.on_file(spark, sf), fx.first_time(spark, sf), fx.ORDERS).plan().new_rows


# query -> the source it is sent
HEADLINES = {
    "append_new_rows": fx.first_time,
    "bulk_append": fx.first_time,
    "insert_output": fx.reissued_parts,
    "insert_if_missing": fx.feed,
    "update_by_key": fx.feed,
    "update_token_checked": fx.feed,
    "update_output": fx.feed,
    "update_natural_key": fx.rebranding,
    "delete_by_key": fx.feed,
    "delete_token_checked": fx.feed,
    "merge_upsert": fx.feed,
    "merge_token_checked": fx.feed,
    "merge_output": fx.feed,
    "merge_mirror": fx.feed,
    "merge_counts": fx.feed,
    "merge_dedup_last": fx.feed_with_repeats,
    "write_back": fx.feed,
    "op_chain": fx.feed,
    "ordered_key_layout": fx.feed,
    "dedup_last": lambda spark, sf: fx.table(spark, sf, "lineitem"),
    "duplicate_keys": lambda spark, sf: fx.table(spark, sf, "lineitem"),
    "stream_merge": lambda spark, sf: fx.table(spark, sf, "events"),
}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Recording the Python call site of every column expression costs several JVM calls each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str) -> float:
    started = time.perf_counter()
    query = QUERIES.get(name, append_new_rows)
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = session()
    seconds, per_10k = {}, {}
    for name in HEADLINES:
        run(spark, name)
    for name, source in HEADLINES.items():
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 4)
        per_10k[name] = round(seconds[name] * 1e7 / max(source(spark, SF_DIR).count(), 1), 1)
    print(json.dumps({
        "metric": "change_operations_total",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "ms_per_10k_rows": per_10k,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
