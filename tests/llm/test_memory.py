"""What tasks hold at once."""

from __future__ import annotations

import collections
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rowtide.llm import common, packing, ranges, shingles, toxicity


class Rows:
    """In place of a frame: gives back the function that it would run."""

    def mapInArrow(self, run, schema):
        return run


def test_dealing_a_chunk_holds_few_copies_of_its_hashes():
    rng = np.random.default_rng(1)
    sets = {n: np.unique(rng.integers(0, 1 << 63, 5000, np.uint64) << np.uint64(1)) for n in range(200)}
    run = ranges.dealt(Rows(), 5, lambda batch: ((n, sets[n]) for n in batch["key"].to_pylist()), chunk_size=1_000_000)
    batch = pa.record_batch({"key": pa.array(range(200))})
    tracemalloc.start()
    found = sum(len(row["tokens"].to_pylist()[0]) // 6 for row in run(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == sum(map(len, sets.values()))
    assert peak < 45 * found


def test_counting_a_range_holds_a_share_of_it_unpacked():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 100_000, np.uint64)
    sets = {n: np.unique(np.append(rng.integers(0, 1 << 63, 900, np.uint64), rng.choice(pool, 100))) for n in range(1000)}
    run = ranges.dealt(Rows(), 0, lambda batch: ((n, sets[n]) for n in batch["key"].to_pylist()), chunk_size=200_000)
    table = pa.Table.from_batches(run(iter([pa.record_batch({"key": pa.array(range(1000))})])))
    tracemalloc.start()
    token, key, count = ranges.counted(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    pairs = [(int(t >> np.uint64(16)), n) for n, tokens in sets.items() for t in tokens]
    times = collections.Counter(t for t, _ in pairs)
    wanted = sorted((n, t, times[t]) for t, n in pairs if times[t] > 1)
    assert list(zip(key.tolist(), token.tolist(), count.tolist(), strict=True)) == wanted
    assert peak < 30 * sum(map(len, sets.values()))


def test_stages_of_the_pipeline_hand_few_rows_to_a_worker_at_once(spark):
    import corpus_pipeline

    before = spark.conf.get(corpus_pipeline.AT_ONCE)
    try:
        spark.conf.unset(corpus_pipeline.AT_ONCE)
        docs = spark.range(3000, numPartitions=1).select(
            F.col("id").alias("doc_id"), F.lit("").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
            F.lit(0).cast("long").alias("n_chars"),
        )
        corpus_pipeline.one_of_each(spark, docs, "")
        sizes = docs.mapInArrow(lambda batches: (pa.record_batch({"n": [b.num_rows]}) for b in batches), "n long").collect()
        assert sum(r["n"] for r in sizes) == 3000 and max(r["n"] for r in sizes) <= corpus_pipeline.ROWS_AT_ONCE
    finally:
        spark.conf.set(corpus_pipeline.AT_ONCE, before)


def test_packing_lets_the_encoder_go():
    common.held(packing.ENCODER, lambda: "words")
    given = []
    rows = type("Given", (), {"mapInArrow": lambda self, run, schema: given.append(run) or self, "__getattr__": lambda self, name: lambda *a: self})()
    packing.gathered(rows, packing.Statistics(0, 0.0, np.zeros(2, np.int64)), "<u2")
    assert list(given[0](iter([]))) == []
    assert common.held(packing.ENCODER, lambda: None) is None
    common.let_go(packing.ENCODER)


def test_clean_rows_stay_in_the_engine(spark):
    """Only texts go to Python, and only scores come back."""
    docs = spark.createDataFrame([(1, "a word", "x"), (2, None, "y")], "doc_id long, text string, source string")
    network = toxicity.Network.fresh(1)
    kept = toxicity.kept(docs, network, below=2.0)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "MapInArrow" not in plan
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


class Groups:
    """In place of a frame: gives back the first function that its groups would go through."""

    def __init__(self, places: int):
        self.sparkSession = self.conf = self
        self.get, self.work = lambda name: str(places), []

    def groupBy(self, *names):
        return self

    def applyInArrow(self, work, schema):
        self.work.append(work)
        return self


def range_table(sets, chunk_size):
    run = ranges.dealt(Rows(), 0, lambda batch: ((n, sets[n]) for n in batch["key"].to_pylist()), chunk_size=chunk_size)
    return pa.Table.from_batches(run(iter([pa.record_batch({"key": pa.array(list(sets))})])))


def test_answering_a_range_holds_no_object_for_each_set():
    """A range of a large table has few hashes of very many sets."""
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 50_000, np.uint64)
    table = range_table({n: np.unique(rng.choice(pool, 2)) for n in range(60_000)}, 20_000)
    groups = Groups(7)
    ranges.gathered(groups, lambda n: 1)
    tracemalloc.start()
    out = groups.work[0](table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 7 and sum(len(row["keys"]) // 8 for row in out.to_pylist()) > 50_000
    assert peak < 180 * 60_000


def test_counting_a_range_of_hashes_and_numbers_that_do_not_fit_a_word():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 1 << 63, 60_000, np.uint64)
    sets = {n: np.unique(np.append(rng.integers(0, 1 << 63, 2, np.uint64), rng.choice(pool, 1))) for n in range(70_000)}
    token, key, count = ranges.counted(range_table(sets, 1 << 30))
    pairs = [(int(t >> np.uint64(16)), n) for n, tokens in sets.items() for t in tokens]
    times = collections.Counter(t for t, _ in pairs)
    wanted = sorted((n, t, times[t]) for t, n in pairs if times[t] > 1)
    assert list(zip(key.tolist(), token.tolist(), count.tolist(), strict=True)) == wanted


def test_sets_that_several_chunks_have_count_once():
    shared = [np.array(tokens, np.uint64) << np.uint64(16) for tokens in ([1, 2, 3], [3, 4], [5, 6], [2, 9])]
    tables = [range_table(dict(part), 1 << 30) for part in (
        [(10, shared[0]), (11, shared[1])], [(10, shared[0]), (12, shared[2])], [(13, shared[3]), (12, shared[2])],
    )]
    token, key, count = ranges.counted(pa.concat_tables(tables))
    assert list(zip(key.tolist(), token.tolist(), count.tolist(), strict=True)) == [(10, 2, 2), (10, 3, 2), (11, 3, 2), (13, 2, 2)]


def test_words_are_hashed_together(monkeypatch):
    """Not one call for each word; sets are those of the words, whatever is hashed with them."""
    texts = ["a b c d e f", "A  b\tc d e f", None, " ", "a b", "\x0bx\x1cy z w v é É\ud800 ", "n" * 70 + " b c d e " + "n" * 70, "12345678 123456789 1 2 3 4"] * 3

    def simple(text):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}

    calls, whole = [], shingles.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(shingles.xxhash, "xxh3_64_intdigest", lambda word: calls.append(word) or whole(word))
    together = [s.tolist() for s in shingles.shingle_sets(texts)]
    assert {len(word) for word in calls} == {70}
    assert [len(s) for s in together] == [len(simple(t)) for t in texts]
    assert together == [next(shingles.shingle_sets([t])).tolist() for t in texts]
    assert together[0] == together[1] == sorted(together[0])
    monkeypatch.setattr(shingles, "AT_ONCE", 20)
    assert [s.tolist() for s in shingles.shingle_sets(texts)] == together
