"""Suffixes of many short strings in order, built column by column.

The collection's Burrows-Wheeler transform starts with the empty suffixes. Each round puts one more symbol
in front of every string's last suffix: the new suffix stands where the symbol's rank in the transform says,
and its common prefix with a neighbour is one more than the least common prefix between the two suffixes
it came from. Transform and common prefixes lie in files that a round reads and writes from end to end.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


class Files:
    """The transform and the common prefixes, a byte each per suffix, in two sets of files by turns.

    A file is written over from its start, so that its pages are used again.
    """

    def __init__(self, folder: str):
        self.files = [[open(os.path.join(folder, f"{name}-{turn}"), "w+b", buffering=0) for name in ("transform", "prefixes")]
                      for turn in (0, 1)]
        self.turn = self.size = 0

    def read(self) -> list[np.ndarray]:
        columns = []
        for file in self.files[self.turn]:
            file.seek(0)
            columns.append(np.frombuffer(file.read(self.size), np.uint8))
        return columns

    def write(self, *columns: np.ndarray) -> None:
        self.turn, self.size = 1 - self.turn, len(columns[0])
        for file, column in zip(self.files[self.turn], columns, strict=True):
            file.seek(0)
            left = memoryview(column).cast("B")
            while len(left):
                left = left[file.write(left):]

    def close(self) -> None:
        for file in (*self.files[0], *self.files[1]):
            file.close()


def least_between(prefixes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least common prefix of each range ``low + 1 .. high``, by minima of powers of two."""
    span = high - low
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(low), np.uint8)
    minima, width = prefixes, 1
    for n in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == n)
        out[at] = np.minimum(minima[low[at] + 1], minima[high[at] - width + 1])
        if len(minima) > width:
            minima = np.minimum(minima[:-width], minima[width:])
        width *= 2
    return out


def ordered_suffixes(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes in order: their string, their length, and the common prefix with the one before.

    Strings have at most 255 symbols and no byte 255 (UTF-8 has none).
    """
    count = len(strings)
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths)
    symbols = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
    last = np.zeros(count, np.uint8)
    last[lengths > 0] = symbols[ends[lengths > 0] - 1]
    with tempfile.TemporaryDirectory() as folder:
        files = Files(folder)
        files.write(last, np.zeros(count, np.uint8))
        going = np.flatnonzero(lengths > 0)
        rank = going
        for done in range(1, int(lengths.max(initial=0)) + 1):
            transform, prefixes = files.read()
            order, place = by_symbol(transform)
            k = place[rank]
            symbol = transform[rank]
            new = count + k - np.count_nonzero(transform == 0)  # rank among all suffixes of the next round
            # Common prefix with the suffix before, and with the one behind, where they begin with the same symbol.
            before = order[np.maximum(k - 1, 0)]
            tied = (k > 0) & (transform[before] == symbol)
            ahead = np.zeros(len(k), np.uint8)
            ahead[tied] = least_between(prefixes, before[tied], rank[tied]) + 1
            after = order[np.minimum(k + 1, len(order) - 1)]
            tied = (k + 1 < len(order)) & (transform[after] == symbol)
            behind = least_between(prefixes, rank[tied], after[tied]) + 1
            more = lengths[going] > done
            following = np.zeros(len(going), np.uint8)
            following[more] = symbols[ends[going[more]] - 1 - done]
            old = np.ones(len(transform) + len(new), bool)
            old[new] = False
            transform = inserted(transform, old, new, following)
            prefixes = inserted(prefixes, old, new, ahead)
            prefixes[new[tied] + 1] = behind
            files.write(transform, prefixes)
            rank, going = new[more], going[more]
        transform, prefixes = files.read()
        files.close()
    # The ranks of a string's suffixes, from the empty one on, by the same step through the whole transform.
    _, place = by_symbol(transform)
    shift = count - np.count_nonzero(transform == 0)
    owner, length = np.zeros(len(transform), np.int32), np.zeros(len(transform), np.uint8)
    going = rank = np.arange(count)
    for done in range(int(lengths.max(initial=0)) + 1):
        owner[rank], length[rank] = going, done
        more = lengths[going] > done
        going, rank = going[more], shift + place[rank[more]]
    return owner, length, prefixes


def by_symbol(transform: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in the order of their symbols, and where each rank comes in it."""
    order = np.argsort(transform, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order), dtype=np.int64)
    return order, place


def inserted(column: np.ndarray, old: np.ndarray, new: np.ndarray, values: np.ndarray) -> np.ndarray:
    wide = np.empty(len(old), column.dtype)
    wide[old] = column
    wide[new] = values
    return wide
