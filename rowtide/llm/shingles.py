"""Word shingles of whole texts as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

WIDTH = 5
FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of texts whose words are hashed at once, unless one text has more; longer words are hashed one by one.
AT_ONCE, LONGEST = 1_000_000, 64

SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: The first bytes, as many as the index says, of a word's eight.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each of the words that start there in ``data``: eight bytes of all words at a time."""
    eights = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    hashes = size.astype(np.uint64)
    long = size > LONGEST
    left = np.flatnonzero(~long)
    for at in range(0, LONGEST, 8):
        left = left[size[left] > at]
        if not len(left):
            break
        hashes[left] = mixed(hashes[left] * FACTOR + (eights[start[left] + at] & FIRST[np.minimum(size[left] - at, 8)]))
    for i in np.flatnonzero(long).tolist():
        hashes[i] = xxhash.xxh3_64_intdigest(data[start[i]:start[i] + size[i]])
    return hashes


def sets_at_once(texts: list[bytes]) -> Iterator[np.ndarray]:
    """``shingle_sets`` of lower-case texts in one array of words."""
    # What follows the last text lets eight bytes be read from any place.
    data = b" ".join([*texts, bytes(8)])
    blank = SPACE[np.frombuffer(data, np.uint8, len(data) - 8)]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    start, end = edge[::2], edge[1::2]
    hashes = word_hashes(data, start, end - start)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    cuts = np.searchsorted(start, begins).tolist()
    code = np.full(max(len(hashes) - WIDTH + 1, 0), WIDTH, np.uint64)
    for k in range(WIDTH):
        code = mixed(code * FACTOR + hashes[k:k + len(code)])
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= WIDTH:
            found = code[a:b - WIDTH + 1]
            found.sort()
            new = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=new[1:])
            yield found[new]
            continue
        few = np.full(min(b - a, 1), b - a, np.uint64)
        for word in hashes[a:b]:
            few = mixed(few * FACTOR + word)
        yield few


def shingle_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted.

    A-Z are lower-cased and words end at space and the control characters 9 to 13. A text of fewer
    words than ``WIDTH`` is one shingle; one without words has none.
    """
    some: list[bytes] = []
    size = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if some and size + len(data) > AT_ONCE:
            yield from sets_at_once(some)
            some, size = [], 0
        some.append(data)
        size += len(data)
    if some:
        yield from sets_at_once(some)
