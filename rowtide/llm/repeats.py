"""Suffix-array deduplication: bytes that a run of 50 bytes of an earlier document covers are removed.

1. Texts with equal bytes: all but the one with the smallest id are removed whole.
2. Every run of 50 bytes has a minimiser, the least hash of the 24-byte strings in it. Equal runs have equal
   ones, so a run whose minimiser no other text has cannot be repeated. Minimisers are counted by
   ranges of their hashes.
3. The stretches of text whose runs share a repeated minimiser are dealt by it, at most 76 bytes each. The
   stretches of a shard are a collection of strings, whose suffixes are put in order column by column
   (``ordered_suffixes``), but for parts whose runs by their hashes occur once; those with a common prefix of 50 bytes stand together, and of these the
   documents behind the first one lose the run.
4. A minimiser that very many texts have would make a shard too large. Its stretches, cut in the same pass, are kept in chunks. Each
   chunk names its distinct runs once, packed by ranges of 128-bit hashes, and a range answers
   with the least document of each (``by_runs``).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.llm.columns import ordered_suffixes
from rowtide.llm.common import lean, lean_rows
from rowtide.llm.components import salt, salts
from rowtide.llm.ranges import BITS, dealt, distinct, firsts, gathered, range_bits
from rowtide.llm.shingles import FACTOR, mixed
from rowtide.session import frozen

RUN, GRAM = 50, 24
WINDOW = RUN - GRAM + 1
#: Texts that may share a minimiser before its runs are grouped one by one, and about how many stretches make a shard.
FREQUENT, SHARD = 500, 3000
#: Minimisers of a chunk and of a range, and stretches that a task gathers before it sends them on.
HASHES, STRETCHES = 1_000_000, 100_000
#: Stretches of frequent minimisers that are asked for together, and the factor of the second hash of a run (any odd number would do).
CHUNK, OTHER_FACTOR = 20_000, np.uint64(0xD6E8FEB86659FD93)
#: Compression of texts and stretches that joins move around.
LEVEL = 6
PIECES = "doc_id long, key long, spans binary"
SPANS = [("doc_id", pa.int64()), ("key", pa.int64()), ("spans", pa.binary())]


# ---------------------------------------------------------------- minimisers


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of GRAM (16 + 8) bytes, from those of 1, 2, 4, 8 and 16."""
    h, factor, width = data.astype(np.uint64) + np.uint64(1), FACTOR, 1
    while width < 8:
        h, factor, width = h[:-width] * factor + h[width:], factor * factor, 2 * width
    sixteen = h[:-8] * factor + h[8:]
    return mixed(sixteen[:-8] * factor + h[16:])


def minimisers(data: np.ndarray) -> np.ndarray:
    """For each run of RUN bytes, the least hash in it."""
    h = gram_hashes(data)
    width = 1
    while 2 * width <= WINDOW:
        h, width = np.minimum(h[:-width], h[width:]), 2 * width
    rest = WINDOW - width
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def minimiser_sets(batch: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    """Text key and distinct minimisers of each document."""
    with np.errstate(over="ignore"):
        for key, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            data = np.frombuffer(bytes_of(text), np.uint8)
            yield key, distinct(minimisers(data)) if len(data) >= RUN else np.empty(0, np.uint64)


def stretches(data: bytes, chosen: np.ndarray) -> Iterator[tuple[int, bytes, list[int]]]:
    """``(minimiser, bytes, starts)`` of each distinct stretch whose runs have one of the chosen minimisers.

    A stretch has at most WINDOW runs, so WINDOW + RUN - 1 bytes.
    """
    with np.errstate(over="ignore"):
        least = minimisers(np.frombuffer(data, np.uint8)) >> np.uint64(64 - BITS)
    first = np.flatnonzero(firsts(least))
    last = np.append(first[1:], len(least))
    least = least[first]
    at = np.minimum(np.searchsorted(chosen, least), len(chosen) - 1)
    wanted = chosen[at] == least
    found: dict[tuple[int, bytes], list[int]] = {}
    for minimiser, a, b in zip(least[wanted].tolist(), first[wanted].tolist(), last[wanted].tolist(), strict=True):
        for start in range(a, b, WINDOW):
            stop = min(start + WINDOW, b)
            found.setdefault((minimiser, data[start:stop + RUN - 1]), []).append(start)
    for (minimiser, piece), starts in found.items():
        yield minimiser, piece, starts


# ---------------------------------------------------------------- runs that an earlier document has


def stretch_rows(held: DataFrame, shards: int) -> DataFrame:
    """``shard, runs, packed``: the stretches of ``held (doc_id, key, packed, tokens)``, those of a task and shard together.

    A value holds lists of document ids, keys, starts and pieces, compressed. Stretches of minimisers that are marked
    as frequent are in no shard, but in chunks, numbered below zero: CHUNK at a time as a task meets them, and how many
    ``runs`` these have.
    """

    def value(rows: list[tuple]) -> bytes:
        return zstandard.ZstdCompressor(level=LEVEL).compress(pickle.dumps(tuple(map(list, zip(*rows, strict=True)))))

    def flushed(numbers: list[int], runs: int | None, values: list[list[tuple]]) -> pa.RecordBatch:
        return pa.record_batch({
            "shard": pa.array(numbers, pa.int64()), "runs": pa.array([runs] * len(numbers), pa.int64()),
            "packed": pa.array([value(rows) for rows in values], pa.binary()),
        })

    def chunk(rows: list[tuple], nth: int) -> pa.RecordBatch:
        return flushed([-1 - (TaskContext.get().partitionId() << 32) - nth], sum(len(piece) - RUN + 1 for *_, piece in rows), [rows])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare: dict[int, list[tuple]] = {}
        often: list[tuple] = []
        size = nth = 0
        for batch in (big.slice(at, 256) for big in batches for at in range(0, big.num_rows, 256)):
            for doc_id, key, row, tokens in zip(*(batch[c].to_pylist() for c in ("doc_id", "key", "packed", "tokens")), strict=True):
                marked = np.frombuffer(tokens, np.uint64)
                chosen = marked & np.uint64((1 << BITS) - 1)
                if not len(chosen):
                    continue
                frequent = set(chosen[marked >> np.uint64(BITS) > 0].tolist())
                for minimiser, piece, starts in stretches(bytes_of(unpacked_row(row)[0]), np.sort(chosen)):
                    if minimiser in frequent:
                        often.append((doc_id, key, starts, piece))
                        if len(often) >= CHUNK:
                            yield chunk(often, nth)
                            often, nth = [], nth + 1
                        continue
                    rare.setdefault(minimiser % shards, []).append((doc_id, key, starts, piece))
                    size += 1
                    if size >= STRETCHES:
                        yield flushed(list(rare), None, list(rare.values()))
                        rare, size = {}, 0
        yield flushed(list(rare), None, list(rare.values()))
        if often:
            yield chunk(often, nth)

    return held.select("doc_id", "key", "packed", "tokens").mapInArrow(lean_rows(run), "shard long, runs long, packed binary")


def stretches_of(values: list[bytes]) -> Iterator[tuple[int, int, list[int], bytes]]:
    """``(document id, key, starts, piece)`` of packed values."""
    for value in values:
        yield from zip(*pickle.loads(zstandard.decompress(value)), strict=True)


def pieces_of(lost: dict[tuple[int, int], list[np.ndarray]]) -> pa.RecordBatch:
    """A row for each document and key of which runs are lost: its runs as maximal spans ``(from, to)``."""
    rows = [key for key, starts in lost.items() if starts]
    parts = [np.concatenate(lost[key]) for key in rows]
    owner = np.repeat(np.arange(len(rows)), [len(p) for p in parts])
    starts = np.concatenate(parts) if parts else np.empty(0, np.int64)
    order = np.lexsort((starts, owner))
    owner, starts = owner[order], starts[order]
    new = firsts(owner)
    new[1:] |= starts[1:] > starts[:-1] + RUN
    begins = np.flatnonzero(new)
    spans = np.stack([starts[begins], starts[np.append(begins[1:], len(starts)) - 1] + RUN], axis=1) if len(begins) else np.empty((0, 2), np.int64)
    at = np.searchsorted(owner[begins], np.arange(len(rows) + 1)).tolist()
    return pa.record_batch({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "key": pa.array([r[1] for r in rows], pa.int64()),
        "spans": pa.array([spans[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()),
    })


def shared_parts(pieces: list[bytes]) -> Iterator[tuple[bytes, int, int]]:
    """``(piece, from, to)``: the longest parts of the pieces all of whose runs have a hash that occurs more than once.

    A run in no part occurs once, so nothing can be lost for it.
    """
    hashes, _, counts = run_hashes(pieces)
    _, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
    often = times[place] > 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    begin = often & np.r_[True, ~often[:-1] | (owner[1:] != owner[:-1])] if len(often) else often
    end = often & np.r_[~often[1:] | (owner[1:] != owner[:-1]), True] if len(often) else often
    before = np.cumsum(counts) - counts
    for n, a, b in zip(owner[begin].tolist(), np.flatnonzero(begin).tolist(), np.flatnonzero(end).tolist(), strict=True):
        yield pieces[n], int(a - before[n]), int(b - before[n]) + RUN


def by_columns(rows: DataFrame) -> DataFrame:
    """``doc_id, key, spans``: what the stretches of each shard repeat of earlier documents.

    Chunks of frequent minimisers pass as they are, as ``chunk, runs, packed``, so that texts are cut into stretches once for both.
    """

    def run(table: pa.Table) -> pa.Table:
        if table["shard"][0].as_py() < 0:
            return pa.table({
                **{c: pa.nulls(len(table), kind) for c, kind in SPANS}, "chunk": table["shard"], "runs": table["runs"], "packed": table["packed"],
            })
        spans = pieces_of_shard(table)
        return spans.append_column("chunk", none := pa.nulls(len(spans), pa.int64())).append_column("runs", none).append_column(
            "packed", pa.nulls(len(spans), pa.binary())
        )

    def pieces_of_shard(table: pa.Table) -> pa.Table:
        held = list(stretches_of(table["packed"].to_pylist()))
        # Equal stretches are one string, and belong to the first document that has it.
        earliest: dict[bytes, int] = {}
        for doc_id, _, _, piece in held:
            earliest[piece] = min(doc_id, earliest.get(piece, doc_id))
        # Of a stretch, the parts whose runs another one can have; equal parts are one string again.
        parts: dict[bytes, list[tuple[int, int]]] = {}
        strings: dict[bytes, int] = {}
        first: list[int] = []
        for piece, begin, end in shared_parts(list(earliest)):
            number = strings.setdefault(piece[begin:end], len(strings))
            if number == len(first):
                first.append(earliest[piece])
            first[number] = min(first[number], earliest[piece])
            parts.setdefault(piece, []).append((begin, number))
        owner, length, prefix = ordered_suffixes(list(strings))
        group = np.cumsum(prefix < RUN)
        full = length >= RUN
        owner, length, group = owner[full], length[full].astype(np.int64), group[full]
        first_doc = np.array(first, np.int64)[owner]
        begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        sizes = np.diff(np.append(begins, len(group)))
        least = np.repeat(np.minimum.reduceat(first_doc, begins), sizes) if len(group) else first_doc
        whole = np.array([len(s) for s in strings], np.int64)
        offset = whole[owner] - length
        by_string = np.lexsort((offset, owner))
        owner, offset, least = owner[by_string], offset[by_string], least[by_string]
        at = np.searchsorted(owner, np.arange(len(strings) + 1))
        out: dict[tuple[int, int], list[np.ndarray]] = {}
        every = np.arange(WINDOW)
        for doc_id, key, starts, piece in held:
            if earliest[piece] < doc_id:
                lost = [every[:len(piece) - RUN + 1]]
            else:
                lost = [begin + offset[at[n]:at[n + 1]][least[at[n]:at[n + 1]] < doc_id] for begin, n in parts.get(piece, ())]
            out.setdefault((doc_id, key), []).extend((s + x) for s in starts for x in lost if len(x))
        return pa.Table.from_batches([pieces_of(out)])

    return rows.groupBy("shard").applyInArrow(lean(run), f"{PIECES}, chunk long, runs long, packed binary")


def run_hashes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each run of the pieces, in order, and how many runs each piece has."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64) + np.uint64(1)
    counts = np.maximum(lengths - RUN + 1, 0)
    begins = np.cumsum(lengths) - lengths
    at = np.repeat(begins, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes = []
    with np.errstate(over="ignore"):
        for first in (FACTOR, OTHER_FACTOR):
            # Strings of 32, then two of these that overlap: together they are the run.
            h, factor, width = mixed(data ^ first), first, 1
            while 2 * width <= RUN:
                h, factor, width = h[:-width] * factor + h[width:], factor * factor, 2 * width
            hashes.append(mixed(mixed(h[at]) * first + h[at + RUN - width]) if len(at) else np.empty(0, np.uint64))
    return hashes[0], hashes[1], counts


@dataclass
class Runs:
    """The distinct runs of the stretches of one chunk, ordered by hash, with the least and highest document of each."""

    held: list[tuple[int, int, list[int], bytes]]
    first: np.ndarray
    second: np.ndarray
    least: np.ndarray
    most: np.ndarray
    #: The distinct pieces' numbers, where the runs of each begin, and the place of every run among the distinct ones.
    number: dict[bytes, int]
    begins: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, packed: bytes) -> Runs:
        held = list(stretches_of([packed]))
        ends: dict[bytes, tuple[int, int]] = {}
        for doc_id, _, _, piece in held:
            low, high = ends.get(piece, (doc_id, doc_id))
            ends[piece] = min(low, doc_id), max(high, doc_id)
        pieces = list(ends)
        one, two, counts = run_hashes(pieces)
        low, high = (np.repeat(np.array([e[n] for e in ends.values()], np.int64), counts) for n in (0, 1))
        order = np.lexsort((two, one))
        begins = np.flatnonzero(firsts(one[order], two[order]))
        place = np.empty(len(order), np.int64)
        place[order] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(order))))
        return cls(
            held, one[order][begins], two[order][begins],
            np.minimum.reduceat(low[order], begins) if len(begins) else low, np.maximum.reduceat(high[order], begins) if len(begins) else high,
            {p: n for n, p in enumerate(pieces)}, np.append(0, np.cumsum(counts)), place,
        )

    def ranges(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of hashes that have runs, and where those of each begin; the last one ends them."""
        numbers = (self.first >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
        begins = np.flatnonzero(firsts(numbers))
        return numbers[begins], np.append(begins, len(numbers))


def by_runs(rows: DataFrame) -> DataFrame:
    """The same, for minimisers that very many texts have: the least document of each run, asked by ranges of hashes.

    ``rows`` is ``chunk, runs, packed``, frozen. A chunk names each of its distinct runs once, by 128 bits of
    hashes and with its least document, packed for each range of hashes; a range answers every chunk the least
    documents of the runs that one of its documents loses. So there is a row per chunk and range, however often a
    passage repeats, and a range holds a run at most once a chunk.
    """
    total = int(rows.agg(F.sum("runs")).first()[0] or 0)
    bits = range_bits(total, HASHES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch["chunk"].to_pylist(), batch["packed"], strict=True):
                runs = Runs.of(packed.as_py())
                numbers, begins = runs.ranges(bits)
                parts = [
                    np.stack([c[a:b].view(np.int64) for c in (runs.first, runs.second, runs.least, runs.most)]).tobytes()
                    for a, b in zip(begins[:-1], begins[1:], strict=True)
                ]
                yield pa.record_batch({
                    "range": pa.array(numbers), "chunk": pa.array([chunk] * len(parts), pa.int64()), "asked": pa.array(parts, pa.binary()),
                })

    def answer(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(a.as_py(), np.int64).reshape(4, -1) for a in table["asked"]]
        one, two, least, most = np.concatenate(asked, axis=1)
        order = np.lexsort((two, one))
        begins = np.flatnonzero(firsts(one[order], two[order]))
        found = np.empty(len(order), np.int64)
        found[order] = np.repeat(np.minimum.reduceat(least[order], begins), np.diff(np.append(begins, len(order))))
        out, at = [], 0
        for part in asked:
            low, high = found[at:at + part.shape[1]], part[3]
            lost = np.flatnonzero(low < high)
            out.append(np.stack([lost, low[lost]]).tobytes() if len(lost) else None)
            at += part.shape[1]
        answers = pa.table({"chunk": table["chunk"], "range": table["range"], "lost": pa.array(out, pa.binary())})
        return answers.filter(answers["lost"].is_valid())

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, answers in zip(batch["packed"], batch["answers"], strict=True):
                runs = Runs.of(packed.as_py())
                numbers, begins = runs.ranges(bits)
                begin_of = dict(zip(numbers.tolist(), begins.tolist(), strict=False))
                least = np.full(len(runs.first), np.iinfo(np.int64).max)
                for one in answers.as_py():
                    lost, low = np.frombuffer(one["lost"], np.int64).reshape(2, -1)
                    least[begin_of[one["range"]] + lost] = low
                out: dict[tuple[int, int], list[np.ndarray]] = {}
                for doc_id, key, starts, piece in runs.held:
                    n = runs.number[piece]
                    lost = np.flatnonzero(least[runs.place[runs.begins[n]:runs.begins[n + 1]]] < doc_id)
                    if len(lost):
                        out.setdefault((doc_id, key), []).extend(s + lost for s in starts)
                yield pieces_of(out)

    asked = rows.select("chunk", "packed").mapInArrow(lean_rows(ask), "range long, chunk long, asked binary")
    answered = asked.groupBy("range").applyInArrow(lean(answer), "chunk long, range long, lost binary")
    by_chunk = answered.groupBy("chunk").agg(F.collect_list(F.struct("range", "lost")).alias("answers"))
    return rows.select("chunk", "packed").join(by_chunk, "chunk").select("packed", "answers").mapInArrow(lean_rows(spans), PIECES)


# ---------------------------------------------------------------- the whole


def text_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(F.col("text"), F.lit("")))


def packed_rows(rows: DataFrame) -> DataFrame:
    """``doc_id, key, packed``: text and carried columns as one compressed value, which joins move around."""
    carried = [c for c in rows.columns if c not in ("doc_id", "key", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = zstandard.ZstdCompressor(level=LEVEL)
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                values = zip(*(batch[c].to_pylist() for c in ("text", *carried)), strict=True)
                packed = [encoder.compress(pickle.dumps(v)) for v in values]
                yield pa.record_batch({"doc_id": batch["doc_id"], "key": batch["key"], "packed": pa.array(packed, pa.binary())})

    return rows.select("doc_id", "key", "text", *carried).mapInArrow(lean_rows(run), "doc_id long, key long, packed binary")


def unpacked_row(packed: bytes) -> tuple:
    return pickle.loads(zstandard.decompress(packed))


def removed_spans(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """``doc_id, key, whole boolean, parts array<binary>`` of the documents of ``docs (doc_id, key, text)`` that lose bytes."""
    facts = frozen(docs.select("doc_id", "key", text_key(2).alias("check"), F.octet_length("text").alias("n")).where(F.col("n") >= RUN))
    same, frequent = ["key", "check", "n"], FREQUENT
    classes = facts.groupBy(*same).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    repeated = classes.where("first < last").select(*same, "first", salts())
    copies = facts.withColumn("salt", salt("doc_id")).join(repeated, [*same, "salt"]).where("first < doc_id").select("doc_id", "key").distinct()
    bits = range_bits(int(facts.agg(F.sum("n")).first()[0] or 0) // (WINDOW // 2), HASHES)
    marked = gathered(dealt(docs, bits, minimiser_sets, HASHES), lambda n: 1, front=lambda count: count > frequent)
    known = frozen(marked.select("key", "tokens").join(classes.select("key", F.col("first").alias("doc_id")), "key"))
    held = packed.join(known.withColumnRenamed("key", "_key"), "doc_id").where("key = _key")
    amount = known.agg(F.sum(F.length("tokens"))).first()[0] or 0
    done = frozen(by_columns(stretch_rows(held, max(1, int(amount) // 8 // SHARD))))
    rare = done.where("packed IS NULL").select("doc_id", "key", "spans")
    found = rare.union(by_runs(done.where("packed IS NOT NULL").select("chunk", "runs", "packed")))
    parts = found.groupBy("doc_id", "key").agg(F.collect_list("spans").alias("parts"))
    whole = copies.select("doc_id", "key", F.lit(True).alias("whole"), F.array().cast("array<binary>").alias("parts"))
    return whole.union(parts.select("doc_id", "key", F.lit(False), "parts"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_text: bool = False
) -> DataFrame:
    """``docs`` without the bytes that runs of 50 bytes of documents with smaller ids cover.

    ``doc_id, kept binary`` (the remaining bytes), ``n_bytes long, spans array<struct<start long, end long>>`` (the
    maximal removed runs) and the columns of ``carry``, a row per row of ``docs``. A run that starts in a
    document with a smaller id goes wherever it stands in a later one; runs are judged on the input,
    overlaps count, and none crosses documents. Repeats within one document stay. Equal texts are told by
    128 bits of hashes and their length. With ``as_text``, ``kept`` is a string, without the characters of
    which a byte went, and null for a null text.

    A null text is empty. A row without id loses nothing and takes nothing from others. Rows that repeat an id
    take nothing from each other. An empty table gives no rows. Other columns are ignored.
    """
    columns = [F.col(f"`{c}`").alias(f"carried_{n}") for n, c in enumerate(carry)]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), *columns)
    rows = rows.withColumn("key", text_key(1))
    named = rows.where(F.col("doc_id").isNotNull())
    packed = packed_rows(named)
    cuts = removed_spans(named.select("doc_id", "key", "text"), packed).withColumnRenamed("key", "_key").withColumnRenamed("doc_id", "_id")
    joined = packed.join(cuts, (F.col("doc_id") == F.col("_id")) & (F.col("key") == F.col("_key")), "left").drop("_id", "_key", "key")
    nameless = packed_rows(rows.where(F.col("doc_id").isNull())).drop("key").withColumns(
        {"whole": F.lit(None).cast("boolean"), "parts": F.lit(None).cast("array<binary>")}
    )
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    carried = [f"carried_{n}" for n in range(len(carry))]
    kinds = [T.StructField(c, rows.schema[c].dataType) for c in carried]
    arrow = to_arrow_schema(T.StructType(kinds))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                batch = big.slice(at, 256)
                kept, sizes, spans, others = [], [], [], []
                for row, whole, parts in zip(*(batch[c].to_pylist() for c in ("packed", "whole", "parts")), strict=True):
                    text, *more = unpacked_row(row)
                    data = bytes_of(text)
                    ranges = [(0, len(data))] if whole else united(parts or ())
                    left = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in ranges)], [*(s for s, _ in ranges), len(data)], strict=True))
                    kept.append(left if not as_text else left.decode("utf-8", "ignore") if text is not None else None)
                    sizes.append(len(data))
                    spans.append([{"start": a, "end": b} for a, b in ranges])
                    others.append(more)
                yield pa.record_batch({
                    "doc_id": batch["doc_id"], "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
                    "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(spans, pa.list_(span)),
                    **{c: pa.array([o[n] for o in others], arrow.field(c).type) for n, c in enumerate(carried)},
                })

    out = joined.unionByName(nameless).mapInArrow(lean_rows(cut), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("kept", T.StringType() if as_text else T.BinaryType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        *kinds,
    ]))
    return out.select("doc_id", "kept", "n_bytes", "spans", *(F.col(c).alias(name) for c, name in zip(carried, carry, strict=True)))


def united(parts: list[bytes]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, np.concatenate([np.frombuffer(p, np.int64).reshape(-1, 2) for p in parts]).tolist())) if parts else ():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out

