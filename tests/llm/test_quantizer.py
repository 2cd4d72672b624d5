"""Codes, codebooks and the tree's nearest entries against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException

from rowtide.llm import quantizer

FIELDS = "vec_id long, embedding array<double>, label int, code string, whole string"


def brute(points, entries):
    apart = ((points[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    return np.array([[int(min(row)), int(list(row).index(min(row)))] for row in apart]).reshape(-1, 2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 4), st.integers(2, 5), st.integers(1, 6), st.integers(0, 2**32 - 1))
def test_tree_finds_the_nearest_entry_and_the_lowest_of_ties(count, width, arity, spread, seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-spread, spread + 1, (count, width))  # many equal entries and equal distances
    points = rng.integers(-2 * spread, 2 * spread + 1, (50, width))
    found = quantizer.Search(points, entries).run(quantizer.build(entries, list(range(count)), arity))
    want = brute(points, entries)
    assert (found.best == want[:, 0]).all() and (found.index == want[:, 1]).all()


def test_tree_rules_entries_out():
    rng = np.random.default_rng(3)
    centres = rng.integers(-10**6, 10**6, (4, 8))
    entries = (centres[:, None] + rng.integers(-50, 50, (4, 4, 8))).reshape(16, 8)
    points = entries[rng.integers(0, 16, 1000)] + rng.integers(-10, 10, (1000, 8))
    found = quantizer.Search(points, entries).run(quantizer.build(entries, list(range(16)), 4))
    assert (found.index == brute(points, entries)[:, 1]).all()
    assert found.measured < 0.6 * 1000 * 16


def brute_codes(rows, parts=8, count=16, rounds=6):
    """Ids, codes and errors of (vec_id, vector, label), and the codebooks' digest."""
    kept = [(i, [int(np.floor(4096 * x)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = np.array([v for _, v, _ in kept], np.int64).reshape(len(kept), parts, -1)
    books = [whole[:count, p].copy() for p in range(parts)]
    for n in range(rounds + 1):
        found = [brute(whole[:, p], books[p]) for p in range(parts)]
        if n < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = whole[found[p][:, 1] == e, p]
                    if len(mine):
                        books[p][e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    digest = hashlib.sha256(",".join(str(int(c)) for b in books for c in b.ravel()).encode()).hexdigest()
    out = []
    for at, (i, _, lab) in enumerate(kept):
        out.append((i, "".join(f"{found[p][at, 1]:02x}" for p in range(parts)), sum(int(found[p][at, 0]) for p in range(parts)), lab))
    return out, digest


def some_vectors(count, seed=5):
    rng = np.random.default_rng(seed)
    data = rng.standard_normal((count, 16)).astype(np.float32).astype(float)
    data[count // 3:count // 2] = data[2]
    rows = [(int(n) if n % 11 else None, v.tolist(), (None, 1, 2)[n % 3]) for n, v in enumerate(data)]
    bad = [None, [None] + [0.5] * 15, [float("nan")] * 16, [float("inf")] + [0.0] * 15]
    return rows + [(5, data[count - 1].tolist(), 1)] + [(10_000 + n, v, 1) for n, v in enumerate(bad)]


@pytest.mark.parametrize("count", [300, 9])
def test_codes_equal_brute_force(spark, count):
    rows = some_vectors(count)
    df = spark.createDataFrame([(*r, "c", "w") for r in rows], FIELDS).repartition(3)
    codes, books = quantizer.compressed(df)
    want, digest = brute_codes(rows)
    got = quantizer.with_label_error(codes).collect()
    assert books.digest() == digest
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label"]) for r in got), key=str) == sorted(want, key=str)
    for label in (None, 1, 2):
        total = sum(w[2] for w in want if w[3] == label)
        assert {r["label_error"] for r in got if r["label"] == label} <= {total}


def test_empty_tables_and_vectors(spark):
    codes, _ = quantizer.compressed(spark.createDataFrame([], FIELDS))
    assert quantizer.with_label_error(codes).count() == 0
    hollow = spark.createDataFrame([(1, [], 1, "", ""), (2, [], 1, "", ""), (3, None, 1, "", "")], FIELDS)
    codes, _ = quantizer.compressed(hollow)
    assert [(r["vec_id"], r["code"], r["error"]) for r in codes.orderBy("vec_id").collect()] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_other_lengths_and_huge_components_stop_the_job(spark):
    mixed = spark.createDataFrame([(n, [0.5] * (16 if n < 16 else 8), 1, "", "") for n in range(20)], FIELDS)
    with pytest.raises(PythonException, match="16 components"):
        quantizer.compressed(mixed)[0].collect()
    with pytest.raises(ValueError, match="8 divides"):
        quantizer.compressed(spark.createDataFrame([(1, [1.0] * 9, 1, "", "")], FIELDS))
    with pytest.raises(OverflowError, match="too large"):
        quantizer.compressed(spark.createDataFrame([(1, [1e12] * 16, 1, "", "")], FIELDS))
