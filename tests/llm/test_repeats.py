"""Removed bytes against a table of all runs of 50 bytes."""

from __future__ import annotations

import random

import pytest

from rowtide.llm import repeats
from rowtide.llm.columns import ordered_suffixes


def brute(docs):
    first = {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        for k in range(len(data) - 49):
            first.setdefault(data[k:k + 50], doc_id)
    out = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k:k + 50]] < doc_id:
                gone[k:k + 50] = b"\1" * 50
        out[doc_id] = bytes(b for b, g in zip(data, gone) if not g)
    return out


def found(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(df).collect()}


def corpus(seed, n):
    rng = random.Random(seed)
    letters = "abcdéf "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(40, 200))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [rng.choice(passages)[rng.randrange(20):] if rng.random() < 0.5
                 else "".join(rng.choice(letters) for _ in range(rng.randrange(0, 120))) for _ in range(rng.randrange(1, 5))]
        docs.append((i, "".join(parts)))
    return docs + [(n + 1, docs[3][1]), (n + 2, docs[3][1])]


@pytest.mark.parametrize("frequent", [500, 2])
def test_equals_table_of_runs(spark, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    docs = corpus(5, 40)
    assert found(spark, docs) == brute(docs)


def test_a_passage_that_very_many_texts_have(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    monkeypatch.setattr(repeats, "HASHES", 2000)
    rng = random.Random(8)
    passage = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(40))
    docs = [(i, "".join(rng.choice("hijk ") for _ in range(rng.randrange(90))) + passage[i % 7:] + str(i * i)) for i in range(2000)]
    assert found(spark, docs) == brute(docs)


def test_texts_are_cut_into_stretches_once(spark, monkeypatch):
    """Those of rare and of frequent minimisers in one pass: texts are shuffled twice, not three times."""
    calls, cut = [], repeats.stretch_rows
    monkeypatch.setattr(repeats, "stretch_rows", lambda *a: calls.append(a) or cut(*a))
    monkeypatch.setattr(repeats, "FREQUENT", 4)
    docs = corpus(6, 40)
    assert found(spark, docs) == brute(docs)
    assert len(calls) == 1


def test_run_hashes_tell_the_runs():
    rng = random.Random(9)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40, 77))) for _ in range(50)] + [b"a" * 76, b"a" * 49, b"a" * 50]
    one, two, counts = repeats.run_hashes(pieces)
    runs = [p[k:k + 50] for p in pieces for k in range(len(p) - 49)]
    assert counts.sum() == len(runs) == len(one) == len(two)
    assert len(set(runs)) == len(set(one.tolist())) == len(set(two.tolist())) == len(set(zip(one.tolist(), two.tolist())))


def test_defined_cases(spark):
    line = "x" * 30 + "y" * 30
    docs = [(1, line), (2, "a" + line + "b"), (3, None), (4, ""), (5, "z" * 200), (6, "z" * 60), (7, line[:49])]
    assert found(spark, docs) == brute(docs)
    assert found(spark, docs)[2] == b"ab"
    df = spark.createDataFrame([(None, line, "k"), (1, line, "k"), (None, line, "k")], "doc_id long, text string, key string")
    rows = repeats.remove_repeats(df, carry=("key",), as_text=True).collect()
    assert [r["kept"] for r in rows] == [line] * 3 and {r["key"] for r in rows} == {"k"}
    assert repeats.remove_repeats(df.where("false")).count() == 0


def test_repeated_ids_take_nothing_from_each_other(spark):
    line = "".join(chr(97 + n % 26) for n in range(80)) + "0123456789"
    df = spark.createDataFrame([(1, line), (1, line), (2, line)], "doc_id long, text string")
    kept = sorted((r["doc_id"], bytes(r["kept"])) for r in repeats.remove_repeats(df).collect())
    assert kept == [(1, line.encode()), (1, line.encode()), (2, b"")]


def test_long_text_and_cut_character(spark):
    shared = "é" * 40
    docs = [(1, "a" + shared), (2, "b" + shared + "c" * 100_000), (3, "long " * 20_000)]
    assert found(spark, docs) == brute(docs)


@pytest.mark.parametrize("seed", range(20))
def test_ordered_suffixes(seed):
    rng = random.Random(seed)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 12))) for _ in range(rng.randrange(1, 15))]
    owner, length, prefix = ordered_suffixes(strings)
    suffixes = [strings[o][len(strings[o]) - n:] for o, n in zip(owner, length)]
    assert suffixes == sorted(suffixes) and len(suffixes) == sum(len(s) + 1 for s in strings)
    for i in range(1, len(suffixes)):
        a, b = suffixes[i - 1], suffixes[i]
        same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert prefix[i] == same
