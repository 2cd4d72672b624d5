"""Vector code compression: product quantisation in integers, nearest entries found by a GNAT over each codebook.

A GNAT (geometric near-neighbour access tree) takes a few entries as split points, gives every other entry to its
nearest split, and stores the range of distances from every split to the entries of every child. One distance from
a query to a split then rules out whole children by the triangle inequality.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.session import frozen

#: Rounding of square roots, sums and differences in doubles stays far below this share of a distance.
SLACK = 2.0**-40
FEWEST = 4


@dataclass
class Node:
    """Split points, what hangs below each, and the conservative distance ranges between them.

    ``low[i, j]`` and ``high[i, j]`` bound the distance from split ``i`` to all of child ``j``, its own split included
    (``i`` itself left out of its own child).
    """

    splits: list[int]
    children: list[Node | None]
    low: np.ndarray
    high: np.ndarray


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points to one entry."""
    apart = points - entry
    return np.einsum("ij,ij->i", apart, apart)


def build(entries: np.ndarray, members: list[int], arity: int) -> Node | None:
    """The tree over ``members``: splits are chosen far apart, ties to the lower index."""
    if not members:
        return None
    splits = [members[0]]
    nearest = squared(entries[members], entries[splits[0]])
    while len(splits) < min(arity, len(members)):
        nearest[[members.index(s) for s in splits]] = -1
        splits.append(members[int(np.argmax(nearest))])
        nearest = np.minimum(nearest, squared(entries[members], entries[splits[-1]]))
    rest = [m for m in members if m not in splits]
    below: list[list[int]] = [[] for _ in splits]
    if rest:
        apart = np.stack([squared(entries[rest], entries[s]) for s in splits])
        for m, home in zip(rest, np.argmin(apart, axis=0)):
            below[home].append(m)
    low = np.full((len(splits), len(splits)), np.inf)
    high = np.full((len(splits), len(splits)), -np.inf)
    for i, split in enumerate(splits):
        for j, group in enumerate(below):
            held = group if i == j else [splits[j], *group]
            if held:
                roots = np.sqrt(squared(entries[held], entries[split]).astype(np.float64))
                low[i, j], high[i, j] = roots.min() * (1 - SLACK), roots.max() * (1 + SLACK)
    children = [build(entries, group, arity) for group in below]
    return Node(splits, children, low, high)


class Search:
    """The nearest entry of each of many points, exactly, ties to the lower index."""

    def __init__(self, points: np.ndarray, entries: np.ndarray):
        self.points, self.entries = points, entries
        self.best = np.full(len(points), np.iinfo(np.int64).max)
        self.index = np.full(len(points), len(entries), np.int64)
        self.measured = 0

    def run(self, tree: Node | None) -> Search:
        if tree is not None and len(self.points):
            self._visit(tree, np.arange(len(self.points)))
        return self

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        alive = np.ones((len(node.splits), len(rows)), bool)
        for i, split in enumerate(node.splits):
            # A split whose child is ruled out was ruled out with it.
            own = np.flatnonzero(alive[i])
            if not len(own):
                continue
            asked = rows[own]
            apart = squared(self.points[asked], self.entries[split])
            self.measured += len(asked)
            # Integers decide, and equal ones by index.
            wins = (apart < self.best[asked]) | ((apart == self.best[asked]) & (split < self.index[asked]))
            self.best[asked[wins]], self.index[asked[wins]] = apart[wins], split
            away = np.sqrt(apart.astype(np.float64))
            reach = np.sqrt(self.best[asked].astype(np.float64)) * (1 + SLACK)
            for j in range(len(node.splits)):
                if j < i and node.children[j] is None:
                    continue
                nearer = np.maximum(away * (1 - SLACK) - node.high[i, j], node.low[i, j] - away * (1 + SLACK))
                # Strictly beyond the best distance: what may tie is kept.
                alive[j, own[nearer * (1 - SLACK) > reach]] = False
        for j, child in enumerate(node.children):
            if child is not None and alive[j].any():
                self._visit(child, rows[alive[j]])


@dataclass
class Codebooks:
    """One codebook per part position: ``entries[part][index]`` are integer components."""

    entries: np.ndarray
    arity: int = FEWEST

    def __post_init__(self):
        self.trees = [build(book, list(range(len(book))), self.arity) for book in self.entries]

    def nearest(self, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of the nearest entry by row and part; distances measured."""
        parts, _, width = self.entries.shape
        cut = whole.reshape(len(whole), parts, width)
        found = [Search(cut[:, p], self.entries[p]).run(self.trees[p]) for p in range(parts)]
        index, best = (np.stack([getattr(f, a) for f in found], axis=1) for a in ("index", "best"))
        return index, best, sum(f.measured for f in found)

    def digest(self) -> str:
        """sha256 over all components, by part, entry and position."""
        return hashlib.sha256(",".join(str(int(c)) for c in self.entries.ravel()).encode()).hexdigest()


def integers(column: pa.ChunkedArray | pa.Array, length: int) -> np.ndarray:
    """The vectors of a batch as a matrix; other lengths and integers too large for exact sums end the job."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and (np.diff(column.offsets.to_numpy()) != length).any():
        raise ValueError(f"all vectors must have {length} components")
    matrix = flat.reshape(len(column), length).astype(np.int64)
    most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
    if 4 * most * most * max(length, 1) >= 2**63:
        raise OverflowError(f"a component of {most} is too large for exact squared distances in 64 bits")
    return matrix


def quantized(df: DataFrame, scale: float, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    """``(vec_id, label, whole)`` of the rows that take part: their components as ``floor(scale * x)``."""

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))

    label = F.lit(None).cast("string") if label_col is None else F.col(f"`{label_col}`")
    rows = df.select(
        F.col(f"`{id_col}`").alias("vec_id"), label.alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).where(F.col("vector").isNotNull() & F.forall("vector", finite))
    return rows.select("vec_id", "label", F.transform("vector", lambda x: F.floor(x * scale)).alias("whole"))


def seeds(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The first codebooks: the parts of the rows with the smallest ids, nulls last, ties to the smaller vector."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("whole")]
    first = [r["whole"] for r in rows.orderBy(*order).limit(entries).select("whole").collect()]
    if not first:
        return np.empty((parts, 0, 0), np.int64)
    length = len(first[0])
    if length % parts or any(len(v) != length for v in first):
        raise ValueError(f"vectors must share one length that {parts} divides")
    whole = integers(pa.array(first, pa.list_(pa.int64())), length)
    return np.ascontiguousarray(whole.reshape(len(first), parts, length // parts).transpose(1, 0, 2))


def moved(rows: DataFrame, books: Codebooks) -> np.ndarray:
    """The codebooks after one round: every used entry becomes the floor of its parts' mean.

    A task adds up its rows by entry; what travels is one sum per task and component of a codebook.
    """
    parts, count, width = books.entries.shape
    cells = parts * count

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((cells, width), np.int64)
        seen = np.zeros(cells, np.int64)
        for batch in batches:
            whole = integers(batch.column("whole"), parts * width)
            if not len(whole):
                continue
            index, _, _ = books.nearest(whole)
            cell = (index + np.arange(parts) * count).ravel()
            order = np.argsort(cell, kind="stable")
            named, at = np.unique(cell[order], return_index=True)
            total[named] += np.add.reduceat(whole.reshape(-1, width)[order], at, axis=0)
            seen += np.bincount(cell, minlength=cells)
        used = np.flatnonzero(seen)
        if len(used):
            yield pa.RecordBatch.from_pydict({
                "cell": pa.array(np.repeat(used, width), pa.int32()),
                "position": pa.array(np.tile(np.arange(width), len(used)), pa.int32()),
                "total": pa.array(total[used].ravel()), "seen": pa.array(np.repeat(seen[used], width)),
            })

    partial = rows.select("whole").mapInArrow(sums, "cell int, position int, total long, seen long")
    whole = partial.groupBy("cell", "position").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("seen").alias("seen")
    )
    after = books.entries.reshape(cells, width).copy()
    for row in whole.collect():  # no more rows than the codebooks have components
        after[row["cell"], row["position"]] = int(row["total"]) // row["seen"]
    return after.reshape(books.entries.shape)


def compressed(
    df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096.0, arity: int = FEWEST,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks: ``vec_id, label, code, error long, measured int``.

    Components count as ``floor(scale * x)``; all else is exact in integers. Codebooks start with the ``entries``
    smallest ids and move ``rounds`` times to the floored means of their parts; an entry without parts stays. ``code``
    has two hex digits per part; ``error`` is the sum of the squared distances to the chosen entries; ``measured``
    counts the distances that the tree had to take for the row's batch, per row, of ``parts * entries``.

    Left out: vectors that are null or hold a null or non-finite component. Null ids are coded, and seed a codebook
    only where fewer than ``entries`` rows have an id. Rows that repeat an id or a vector are rows of their own; equal
    entries tie to the lower index. Fewer rows than ``entries`` give smaller codebooks, an empty table no rows. Empty
    vectors have parts without components: code 0, error 0. Vectors of several lengths, of a length that ``parts``
    does not divide, or with components beyond about ``2**30 / sqrt(length)`` after scaling stop the job with
    a message. Other columns are ignored.
    """
    rows = frozen(quantized(df, scale, id_col, vector_col, label_col))
    books = Codebooks(seeds(rows, parts, entries), arity)
    _, count, width = books.entries.shape
    for _ in range(rounds if count and width else 0):
        books = Codebooks(moved(rows, books), arity)
    final = books

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = integers(batch.column("whole"), parts * width)
            index, best, measured = final.nearest(whole)
            digits = index.astype(np.uint8).tobytes().hex()
            step = 2 * parts
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.array([digits[at:at + step] for at in range(0, len(digits), step)], pa.string()),
                pa.array(best.sum(axis=1), pa.int64()),
                pa.array(np.full(len(whole), measured // max(len(whole), 1)), pa.int32()),
            ], ["vec_id", "label", "code", "error", "measured"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long, measured int"
    return rows.mapInArrow(coded, schema), books


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the errors summed over equal labels, nulls together."""
    fixed = frozen(codes)
    label = F.col("label")
    sums = fixed.groupBy(label.alias("_label")).agg(F.sum("error").alias("label_error"))
    return fixed.join(sums, label.eqNullSafe(F.col("_label"))).drop("_label")
