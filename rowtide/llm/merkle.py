"""A Merkle manifest of a table: a ternary hash tree per group, a tree over the groups, a proof for every row.

The hash of a node is the lowercase hex sha256 of its children's hex digests, written one after another; three
consecutive nodes make one of the next level, the last run of a level may hold fewer. A *page* is a subtree of
``3 ** DEPTH`` leaves. Pages are hashed independently, level by level of pages. For the proofs, every leaf page is
an octopus: it works out the smallest set of nodes that it lacks to know all paths of its leaves, fetches them in one
join, derives all shared interiors once, and expands the proof of each leaf by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.prefix import running
from rowtide.session import frozen

ARITY = 3
#: Levels of a page, which holds ``ARITY ** DEPTH`` nodes of its lowest level at most.
DEPTH = 7
PAGE = ARITY**DEPTH
#: Nodes high up are asked for by many pages; each is stored so many times, and pages ask for their own copy.
COPIES = 16

Coordinate = tuple[int, int]


def hashed(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(width: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while width > 1:
        width, levels = -(-width // ARITY), levels + 1
    return levels


def parents(digests: Sequence[str]) -> list[str]:
    """The next level; the first digest is the first of a run."""
    return [hashed("".join(digests[at:at + ARITY])) for at in range(0, len(digests), ARITY)]


def missing(leaves: Iterable[int], width: int) -> list[Coordinate]:
    """The smallest set of nodes, as (level, index), that with these leaves makes all their paths known."""
    known, level, asked = sorted(set(leaves)), 0, []
    while width > 1 and known:
        held = set(known)
        runs = list(dict.fromkeys(i // ARITY for i in known))
        for run in runs:
            asked += [(level, i) for i in range(run * ARITY, min(run * ARITY + ARITY, width)) if i not in held]
        known, width, level = runs, -(-width // ARITY), level + 1
    return asked


def derived(leaves: Mapping[int, str], fetched: Mapping[Coordinate, str], width: int) -> list[dict[int, str]]:
    """All nodes that the leaves and the fetched nodes give, by level; the last level holds the root."""
    levels, known, level = [], dict(leaves), 0
    while True:
        runs = list(dict.fromkeys(i // ARITY for i in sorted(known)))
        for run in runs:
            for i in range(run * ARITY, min(run * ARITY + ARITY, width)):
                if i not in known:
                    known[i] = fetched[level, i]
        levels.append(known)
        if width <= 1:
            return levels
        above = {r: hashed("".join(known[i] for i in range(r * ARITY, min(r * ARITY + ARITY, width)))) for r in runs}
        known, width, level = above, -(-width // ARITY), level + 1


def siblings(levels: Sequence[Mapping[int, str]], index: int, width: int) -> list[tuple[str, str]]:
    """Per level below the root what stands before and what behind the node on the path of a leaf."""
    path = []
    for level in levels[:-1]:
        first = index - index % ARITY
        run = range(first, min(first + ARITY, width))
        path.append(("".join(level[i] for i in run if i < index), "".join(level[i] for i in run if i > index)))
        index, width = index // ARITY, -(-width // ARITY)
    return path


def folded(leaf: str, path: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for before, behind in path:
        leaf = hashed(before + leaf + behind)
    return leaf


def encoded(*values: Column) -> Column:
    """``-`` for null, else the byte count, a colon and the value; one after another."""
    texts = [value.cast("string") for value in values]
    return F.concat(*(
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts
    ))


def _nodes(leaves: DataFrame, widest: int, keep_low: bool) -> DataFrame:
    """The nodes of all trees, ``tree, level, idx, width, digest``, of ``leaves`` (``tree, idx, width, digest``).

    ``width`` is the number of leaves of the tree. Kept are the tops of the leaf pages and all above, or with
    ``keep_low`` every node. Every pass climbs the levels of one page; a tree of any size is done after a few.
    """
    stored = [leaves.select("tree", F.lit(0).alias("level"), "idx", "width", "digest")] if keep_low else []
    level = 0
    nodes = leaves.select("tree", "idx", "width", "digest")
    schema = "tree string, level int, idx long, width long, digest string"
    while True:
        below, every = level, keep_low or level > 0

        def climb(key: tuple, page: pa.Table) -> pa.Table:
            rows = page.sort_by("idx")
            digests, first = rows["digest"].to_pylist(), rows["idx"][0].as_py()
            width = rows["width"][0].as_py()
            left, found = height(width) - below, []
            for step in range(min(DEPTH, left)):
                digests, first = parents(digests), first // ARITY
                if every or step + 1 == min(DEPTH, left):
                    found += [(below + step + 1, first + i, d) for i, d in enumerate(digests)]
            if not below and not left and not keep_low:  # a lone leaf is its own root
                found.append((0, 0, digests[0]))
            levels, indices, hashes = zip(*found) if found else ((), (), ())
            return pa.table({
                "tree": pa.array([key[0].as_py()] * len(found), pa.string()),
                "level": pa.array(levels, pa.int32()), "idx": pa.array(indices, pa.int64()),
                "width": pa.array([width] * len(found), pa.int64()), "digest": pa.array(hashes, pa.string()),
            })

        pages = nodes.withColumn("page", F.expr(f"idx div {PAGE}")).groupBy("tree", "page")
        made = frozen(pages.applyInArrow(climb, schema))
        stored.append(made)
        level += DEPTH
        if height(widest) <= level:
            break
        nodes = made.where(F.col("level") == level).select("tree", "idx", "width", "digest")
    return reduce(DataFrame.unionByName, stored)


def _root_level(width: Column, widest: int) -> Column:
    """``height`` as a column, for widths up to ``widest``."""
    level = F.lit(0)
    for n in range(height(widest)):
        level = F.when(width > ARITY**n, n + 1).otherwise(level)
    return level


def _widest(rows: DataFrame) -> int:
    return rows.agg(F.max("width")).first()[0] or 1


def manifest(
    docs: DataFrame, columns: Sequence[str], group_col: str, order_col: str, tampered: Mapping[str, Column] | None = None,
    when: Column | None = None,
) -> DataFrame:
    """Every row as a leaf, with its trees' roots and its proof.

    A leaf is the hash of the row's ``columns`` as ``encoded``. Rows with one value of ``group_col`` are one tree, in
    ascending order of ``order_col``; the groups' roots, in ascending order of the group, are the leaves of the tree
    over all. Returns ``id`` (the order column), ``leaf, subroot, root, proof_sha256`` (hash of all siblings on the path,
    from the leaf up, left to right), ``folded_root`` and ``verified``: the root that the stored siblings give for the
    row as it is now, and whether it is the manifest's. ``tampered`` names the columns that have other values by now, on
    the rows for which ``when`` holds.

    Nulls are values of their own: a null group is a tree, the first; null ids come first in theirs. Rows that repeat an
    id are leaves of their own, ordered by their hash, equal rows in any order. Empty and null texts hash differently.
    A group of one row has that leaf as its root and no siblings in it. An empty table gives no rows. Other columns are ignored.
    """
    own = {name: F.col(f"`{name}`") for name in columns}
    now = {**own, **(tampered or {})}
    tree = F.coalesce(F.concat(F.lit("g"), own[group_col].cast("string")), F.lit(""))
    rows = docs.select(
        tree.alias("tree"), F.col(f"`{order_col}`").alias("id"),
        F.sha2(encoded(*own.values()), 256).alias("digest"),
        (F.when(when, F.sha2(encoded(*now.values()), 256)) if when is not None else F.lit(None).cast("string")).alias("other"),
    )
    numbered = running(rows, ("id", "digest"), within=("tree",))
    leaves = frozen(numbered.select(
        *rows.columns, F.col("place").alias("idx"), F.col("group_rows").alias("width"),
        F.expr(f"place div {PAGE}").alias("page"),
    ))
    widest = _widest(leaves)
    nodes = _nodes(leaves, widest, keep_low=False)
    roots = nodes.where((F.col("idx") == 0) & (F.col("level") == _root_level(F.col("width"), widest)))
    groups = frozen(running(roots.select("tree", "digest"), ("tree",)).select(
        F.lit(None).cast("string").alias("tree"), F.col("tree").alias("member"), F.col("place").alias("idx"),
        F.col("group_rows").alias("width"), "digest",
    ))
    top = _nodes(groups, _widest(groups), keep_low=True)
    return _proofs(leaves, nodes, groups, top)


def _requests(pages: DataFrame) -> DataFrame:
    """What each leaf page lacks, as coordinates in its own tree and (null tree) in the tree over the groups."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for page in batch.to_pylist():
                first = page["page"] * PAGE
                inside = range(first, min(first + PAGE, page["width"]))
                found += [(page["tree"], page["page"], page["tree"], *c) for c in missing(inside, page["width"])]
                found += [(page["tree"], page["page"], None, *c) for c in missing([page["place"]], page["groups"])]
            columns = list(zip(*found)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["for_tree", "for_page", "of", "at_level", "at_idx"]
            )

    return pages.mapInArrow(ask, "for_tree string, for_page long, of string, at_level int, at_idx long")


def _proofs(leaves: DataFrame, nodes: DataFrame, groups: DataFrame, top: DataFrame) -> DataFrame:
    place = groups.select(F.col("member").alias("tree"), F.col("idx").alias("place"), F.col("width").alias("groups"))
    pages = leaves.where(F.col("idx") % PAGE == 0).select("tree", "page", "width").join(place, "tree")

    # A node of the lowest levels is asked for by few pages; those above, by any number.
    low = F.col("level") < 2 * DEPTH
    stored = nodes.unionByName(top).select(
        F.coalesce("tree", F.lit("-")).alias("of"), "level", "idx", "digest",
        F.explode(F.when(F.col("tree").isNotNull() & low, F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), F.lit(COPIES - 1)))).alias("copy"),
    )
    many = F.col("of").isNull() | (F.col("at_level") >= 2 * DEPTH)
    asked = _requests(pages).select(
        "for_tree", "for_page", F.coalesce("of", F.lit("-")).alias("of"), F.col("at_level").alias("level"),
        F.col("at_idx").alias("idx"), F.when(many, F.pmod(F.xxhash64("for_tree", "for_page"), F.lit(COPIES))).otherwise(0)
        .cast("int").alias("copy"),
    )
    fetched = asked.join(stored, ["of", "level", "idx", "copy"]).select(
        "for_tree", "for_page", (F.col("of") == "-").alias("over"), "level", "idx", "digest",
        F.lit(None).cast("long").alias("groups"),
    )
    # One more row a page: where its group stands among the groups.
    told = pages.select(
        F.col("tree").alias("for_tree"), F.col("page").alias("for_page"), F.lit(True).alias("over"),
        F.lit(-1).alias("level"), F.col("place").alias("idx"), F.lit(None).cast("string").alias("digest"), "groups",
    )

    id_type = leaves.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )

    def expand(page: pa.Table, asked: pa.Table) -> pa.Table:
        own, above, place, groups = {}, {}, 0, 1
        for row in asked.to_pylist():
            if row["level"] < 0:
                place, groups = row["idx"], row["groups"]
            else:
                (above if row["over"] else own)[row["level"], row["idx"]] = row["digest"]
        width = page["width"][0].as_py()
        digests = dict(zip(page["idx"].to_pylist(), page["digest"].to_pylist()))
        levels = derived(digests, own, width)
        subroot = levels[-1][0]
        over = derived({place: subroot}, above, groups)
        shared = siblings(over, place, groups)
        root = over[-1][0]
        proofs, reached = [], []
        for idx, other in zip(page["idx"].to_pylist(), page["other"].to_pylist()):
            path = siblings(levels, idx, width) + shared
            proofs.append(hashed("".join(before + behind for before, behind in path)))
            reached.append(folded(digests[idx] if other is None else other, path))
        count = page.num_rows
        return pa.table({
            "id": page["id"], "leaf": page["digest"], "subroot": pa.array([subroot] * count),
            "root": pa.array([root] * count), "proof_sha256": pa.array(proofs), "folded_root": pa.array(reached),
            "verified": pa.array([r == root for r in reached]),
        })

    grouped = fetched.unionByName(told).groupBy("for_tree", "for_page")
    return leaves.groupBy("tree", "page").cogroup(grouped).applyInArrow(expand, schema)
