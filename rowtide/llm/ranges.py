"""Which hashes several sets share, without a row per hash: sets are dealt by ranges of their hashes in packed chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rowtide.llm.common import lean, released

#: Hashes that a task gathers before it deals them, and about how many a range holds, unless others are asked for.
CHUNK, RANGE = 2_000_000, 4_000_000


#: Bits of a hash that are dealt, in 6 bytes.
BITS = 48

#: Shares of a range, a power of two, that a task counts one after another.
PARTS = 4

#: Hashes that are compared at once with those before them.
SLICE = 1 << 20

#: The packed columns of a range and chunk.
COLUMNS = ("keys", "sizes", "counts", "tokens", "joint", "common_counts", "common")


def packed(tokens: np.ndarray) -> bytes:
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // BITS, 8), np.uint8)
    wide[:, :BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, BITS // 8)
    return wide.view("<u8").ravel()


def firsts(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order; sorting is faster than what ``np.unique`` does to find them."""
    values = np.sort(values)
    new = firsts(values)
    return values if new.all() else values[new]


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs in order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = firsts(a, b)
    return a[new], b[new]


def range_bits(total: int, each: int = RANGE) -> int:
    """The bits that number the ranges for so many hashes."""
    return (total // each).bit_length()


def dealt(docs: DataFrame, bits: int, sets_of: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]], chunk_size: int = CHUNK) -> DataFrame:
    """The hashes of all sets by ranges: a row for each of the ``2**bits`` ranges and chunk of documents.

    ``keys``: the chunk's distinct sets that have a hash in the range. ``counts`` and ``tokens``: how many hashes of the range each of them alone
    has, and which. ``joint``: the hashes that several of them have; ``common_counts`` and ``common``: whose
    these are. ``sizes``: how many hashes each set has in all. Of a hash of 64 bits the first 48 are dealt. So a chunk names
    a hash to other chunks once, however many sets have it.
    """
    ranges = 1 << bits

    def rows(keys: list[int], sets: list[np.ndarray], whole: list[int]) -> Iterator[dict]:
        kind = np.uint16 if len(sets) <= 1 << 64 - BITS else np.int32
        owner = np.repeat(np.arange(len(sets), dtype=kind), [len(s) for s in sets])
        tokens = np.concatenate(sets)
        sets.clear()
        if kind == np.uint16:
            # A hash and its owner fit a word, and words sort faster than places.
            tokens <<= np.uint64(64 - BITS)
            tokens |= owner
            tokens.sort()
            owner = tokens.astype(kind)
            tokens >>= np.uint64(64 - BITS)
        else:
            order = np.argsort(tokens, kind="stable")
            owner, tokens = owner[order], tokens[order]
            del order
        named, sizes = np.array(keys, np.int64), np.array(whole, np.uint32)
        # In order of the hashes, a range is a stretch of them.
        cuts = np.searchsorted(tokens, np.arange(1, ranges, dtype=np.uint64) << np.uint64(BITS - bits)).tolist()
        for r, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(tokens)], strict=True)):
            token, own = tokens[a:b], owner[a:b]
            new = firsts(token)
            times = np.diff(np.append(np.flatnonzero(new), len(token)))
            several = np.repeat(times > 1, times)

            def parts(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                """Hashes by set, and counts."""
                held, of = token[mask], own[mask]
                return held[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(named))

            single, s_counts = parts(~several)
            common, c_counts = parts(several)
            here = (s_counts > 0) | (c_counts > 0)
            yield {
                "range": r, "keys": named[here].tobytes(), "sizes": sizes[here].tobytes(),
                "counts": s_counts[here].astype(np.uint32).tobytes(), "tokens": packed(single), "joint": packed(token[new][times > 1]),
                "common_counts": c_counts[here].astype(np.uint32).tobytes(), "common": packed(common),
            }

    schema = pa.schema([("range", pa.int32()), *((n, pa.binary()) for n in COLUMNS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: dict[int, np.ndarray] = {}
        whole: list[int] = []
        size = 0

        def chunk_rows() -> Iterator[pa.RecordBatch]:
            keys, sets, sizes = list(chunk), list(chunk.values()), list(whole)
            chunk.clear()
            whole.clear()
            for row in rows(keys, sets, sizes):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for big in batches:
            for at in range(0, big.num_rows, 512):
                batch = big.slice(at, 512)
                for key, tokens in sets_of(batch):
                    if not len(tokens) or key in chunk:
                        continue
                    chunk[key] = distinct(tokens >> np.uint64(64 - BITS))
                    whole.append(len(tokens))
                    size += len(tokens)
                    if size >= chunk_size:
                        yield from chunk_rows()
                        size = 0
                        released()
        if chunk:
            yield from chunk_rows()
        released()

    return docs.mapInArrow(run, "range int, " + ", ".join(f"{n} binary" for n in COLUMNS))


def counted(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one range: ``token, key, count`` of the hashes that several sets have, by key and hash."""
    token, owner, count, every, _ = numbered(table)
    return token, every[owner], count


def numbered(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``counted`` with numbers of keys; the keys they stand for, in order, and how many hashes each of these has in all."""

    def column(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), kind) for x in table[name]]

    keys = column("keys", np.int64)
    every, number = np.unique(np.concatenate(keys), return_inverse=True)
    whole = np.zeros(len(every), np.uint32)
    whole[number] = np.concatenate(column("sizes", np.uint32))
    numbers = np.split(number.astype(np.int32), np.cumsum([len(k) for k in keys])[:-1])
    pieces = [
        (data, number, count) for tokens, counts in (("tokens", "counts"), ("common", "common_counts"))
        for data, number, count in zip(column(tokens, np.uint8), numbers, column(counts, np.uint32), strict=True)
    ]
    token = np.empty(sum(len(data) * 8 // BITS for data, _, _ in pieces), np.uint64)
    at = 0
    for data, _, _ in pieces:
        held = unpacked(data)
        token[at:at + len(held)] = held
        at += len(held)
    # The bits in which hashes of the range differ, and those of a number.
    low, high = (int(token.min()), int(token.max())) if len(token) else (0, 0)
    below, wide = max(len(every) - 1, 0).bit_length(), (high - low).bit_length()
    if below + wide > 64:
        del token
        return *in_shares(column, numbers), every, whole
    token -= np.uint64(low)
    token <<= np.uint64(below)
    at = 0
    for _, number, count in pieces:
        owner = np.repeat(number, count)
        token[at:at + len(owner)] |= owner.astype(np.uint64)
        at += len(owner)
    found, owner, count = in_words(token, below, wide)
    return found + np.uint64(low), owner, count, every, whole


def in_words(word: np.ndarray, below: int, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes that several numbers have, numbers and counts, where both fit a word, the number in its last bits: words sort faster than places."""
    shift = np.uint64(below)
    word.sort()
    same = np.zeros(len(word), bool)
    for a in range(0, len(word) - 1, SLICE):
        b = min(a + SLICE, len(word) - 1)
        same[a + 1:b + 1] = (word[a:b] ^ word[a + 1:b + 1]) >> shift == 0
    # A set that is in several chunks names its hashes several times.
    known = same.copy()
    known[:-1] |= same[1:]
    word = word[known]
    new = firsts(word)
    word = word[new]
    first = firsts(word >> shift)
    times = np.diff(np.append(np.flatnonzero(first), len(word)))
    count = np.repeat(times, times)
    word, count = word[count > 1], count[count > 1]
    token, owner = word >> shift, (word & np.uint64((1 << below) - 1)).astype(np.int32)
    order = np.argsort((owner.astype(np.uint64) << np.uint64(wide)) | token)
    return token[order], owner[order], count[order]


def in_shares(column: Callable, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for any range. Hashes are counted by their last bits, PARTS times one share of them, so that a task unpacks and sorts no more at once."""

    def shared(part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the part, the number of a set that has each, and how many have it."""

        def of_part(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            token = unpacked(data)
            mine = token & np.uint64(PARTS - 1) == part
            return token[mine], mine

        def pairs(tokens: str, counts: str) -> tuple[np.ndarray, np.ndarray]:
            held, owner = [], []
            for data, number, count in zip(column(tokens, np.uint8), numbers, column(counts, np.uint32), strict=True):
                token, mine = of_part(data)
                held.append(token)
                owner.append(np.repeat(number, count)[mine])
            return np.concatenate(held), np.concatenate(owner)

        def once(token: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            new = firsts(token, owner)
            return (token, owner) if new.all() else (token[new], owner[new])

        token, owner = once(*pairs("tokens", "counts"))
        same = token[1:] == token[:-1]
        known = np.isin(token, np.unique(np.concatenate([of_part(x)[0] for x in column("joint", np.uint8)])), kind="sort")
        known[1:] |= same
        known[:-1] |= same
        token, owner = token[known], owner[known]
        more, owners = pairs("common", "common_counts")
        token, owner = once(np.concatenate([token, more]), np.concatenate([owner, owners]))
        times = np.diff(np.append(np.flatnonzero(firsts(token)), len(token)))
        return token, owner, np.repeat(times, times)

    token, owner, count = (np.concatenate(c) for c in zip(*map(shared, range(PARTS)), strict=True))
    order = np.lexsort((token, owner))
    return token[order], owner[order], count[order]


def power(count: np.ndarray) -> np.ndarray:
    """The power of two of a count."""
    return np.log2(np.maximum(count, 1)).astype(np.uint64)


def gathered(chunks: DataFrame, enough: Callable[[int], int], front: Callable[[np.ndarray], np.ndarray] = power) -> DataFrame:
    """``key, n, tokens binary``: the sets of which at least ``enough(n)`` of ``n`` hashes are shared with others.

    ``tokens`` are the shared hashes in order, each with what ``front`` makes of the number of sets that have it in
    front, by default so that the rare ones come first. A range sends one row to each of as many places as there are shuffle
    partitions, with what it has of all sets that are put together there.
    """
    places = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(table: pa.Table) -> pa.Table:
        token, owner, count, every, whole = numbered(table)
        token = token | (front(count).astype(np.uint64) << np.uint64(BITS))
        first = np.flatnonzero(firsts(owner))
        number, held = owner[first], np.diff(np.append(first, len(owner)))
        named, size = every[number], whole[number]
        # Of near copies much is shared in every range, but a range alone cannot tell.
        place = (named % places).astype(np.uint16 if places <= 1 << 16 else np.int32)
        order = np.argsort(place, kind="stable")
        by_token = np.argsort(np.repeat(place, held), kind="stable")
        token, place, named, held, size = token[by_token], place[order], named[order], held[order], size[order]
        begins = np.flatnonzero(firsts(place))
        ends = np.append(begins, len(place))[1:]
        offset = np.append(0, np.cumsum(held))
        return pa.table({
            "place": pa.array(place[begins], pa.int32()),
            "keys": pa.array([named[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            "sizes": pa.array([size[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
            "counts": pa.array([held[a:b].astype(np.uint32).tobytes() for a, b in zip(begins, ends)], pa.binary()),
            "tokens": pa.array([token[offset[a]:offset[b]].tobytes() for a, b in zip(begins, ends)], pa.binary()),
        })

    def gather(table: pa.Table) -> pa.Table:
        def column(name: str, kind: type) -> np.ndarray:
            return np.concatenate([np.frombuffer(x, kind) for x in table[name].to_pylist()])

        key, size, held = column("keys", np.int64), column("sizes", np.uint32), column("counts", np.uint32)
        token = column("tokens", np.uint64)
        named, number = np.unique(key, return_inverse=True)
        whole = np.zeros(len(named), np.int64)
        whole[number] = size
        owner = np.repeat(number.astype(np.uint16 if len(named) <= 1 << 16 else np.int32), held)
        order = np.argsort(token)
        order = order[np.argsort(owner[order], kind="stable")]
        token = token[order]
        length = np.bincount(owner, minlength=len(named))
        offset = np.append(0, np.cumsum(length))
        kept = np.flatnonzero(length >= np.array([enough(n) for n in whole.tolist()], np.int64))
        return pa.table({
            "key": pa.array(named[kept], pa.int64()), "n": pa.array(whole[kept], pa.int64()),
            "tokens": pa.array([token[offset[i]:offset[i + 1]].tobytes() for i in kept.tolist()], pa.binary()),
        })

    packed_rows = chunks.groupBy("range").applyInArrow(
        lean(deal), "place int, keys binary, sizes binary, counts binary, tokens binary"
    )
    return packed_rows.groupBy("place").applyInArrow(lean(gather), "key long, n long, tokens binary")
