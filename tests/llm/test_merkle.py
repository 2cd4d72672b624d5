"""The manifest against trees built in one piece, and the octopus against every subset."""

from __future__ import annotations

import hashlib
import itertools

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide.llm import merkle

FIELDS = "doc_id long, source string, text string, tree string, idx int, digest string, place int"


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def path(levels, index):
    out = []
    for level in levels[:-1]:
        first = index - index % 3
        out.append(("".join(level[first:index]), "".join(level[index + 1:first + 3])))
        index //= 3
    return out


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute(rows):
    """Per row (id, leaf, subroot, root, proof, folded, verified), line ends gone from even ids."""
    groups = {}
    for doc_id, source, text, *_ in rows:
        leaf = H(field(doc_id) + field(source) + field(text))
        now = text.replace("\n", "") if text is not None and doc_id is not None and doc_id % 2 == 0 else text
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id, H(field(doc_id) + field(source) + field(now))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort()
        trees[name] = tree([g[2] for g in groups[name]])
    over = tree([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for index, (_, _, leaf, doc_id, now) in enumerate(groups[name]):
            steps = path(trees[name], index) + path(over, place)
            reached = now
            for before, behind in steps:
                reached = H(before + reached + behind)
            out.append((
                doc_id, leaf, trees[name][-1][0], over[-1][0], H("".join(a + b for a, b in steps)), reached,
                reached == over[-1][0],
            ))
    return out


def made(df):
    found = merkle.manifest(
        df, ("doc_id", "source", "text"), "source", "doc_id",
        tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, when=F.col("doc_id") % 2 == 0,
    )
    return [tuple(r) for r in found.collect()]


def some_rows(count):
    texts = [None, "", "one\ntwo", "plain", "ü\n\n", "x" * 3000 + "\n"]
    rows = []
    for n in range(count):
        source = "hot" if n % 3 == 0 else (None, "", "a", "ä", "zz", "only" if n == 10 else "b")[n % 6]
        rows.append((n if n % 13 else None, source, texts[n % 6], "t", n, "d", n))
    return rows + rows[:4]


@pytest.mark.parametrize("depth", [1, 2, 7])
def test_manifest_equals_whole_trees(spark, monkeypatch, depth):
    """Small pages give several passes, and nodes that are stored in copies."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "PAGE", 3**depth)
    rows = some_rows(120)
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    assert sorted(made(df), key=str) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("rows", [[], [(1, "s", "t\n", "", 0, "", 0)], [(2, None, "t\n", "", 0, "", 0), (2, None, "t\n", "", 0, "", 0)]])
def test_small_tables(spark, rows):
    assert sorted(made(spark.createDataFrame(rows, FIELDS)), key=str) == sorted(brute(rows), key=str)


def test_many_groups(spark):
    rows = [(n, f"source {n % 50}", "a\nb", "", 0, "", 0) for n in range(130)]
    assert sorted(made(spark.createDataFrame(rows, FIELDS)), key=str) == sorted(brute(rows), key=str)


def known(leaves, fetched, width):
    """Whether every node on a path and its siblings follow from what is given."""
    nodes = {(0, i) for i in leaves} | set(fetched)
    paths, level = set(leaves), 0
    while width > 1:
        runs = {i // 3 for i in paths}
        if any((level, i) not in nodes for r in runs for i in range(3 * r, min(3 * r + 3, width))):
            return False
        nodes |= {(level + 1, r) for r in runs}
        paths, width, level = runs, -(-width // 3), level + 1
    return True


def test_the_octopus_asks_for_no_node_too_many():
    for width in range(1, 11):
        for count in range(1, width + 1):
            for leaves in itertools.combinations(range(width), count):
                asked = merkle.missing(leaves, width)
                assert known(leaves, asked, width)
                assert not any(known(leaves, asked[:n] + asked[n + 1:], width) for n in range(len(asked)))


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 200), st.data())
def test_proofs_of_any_subset_fold_to_the_root(width, data):
    leaves = data.draw(st.sets(st.integers(0, width - 1), min_size=1))
    levels = tree([H(str(n)) for n in range(width)])
    fetched = {(level, index): levels[level][index] for level, index in merkle.missing(leaves, width)}
    got = merkle.derived({n: levels[0][n] for n in leaves}, fetched, width)
    assert got[-1][0] == levels[-1][0]
    for n in leaves:
        steps = merkle.siblings(got, n, width)
        assert steps == path(levels, n)
        assert merkle.folded(levels[0][n], steps) == levels[-1][0]
