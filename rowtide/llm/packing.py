"""Lexical retrieval packing: BM25 neighbours of a seed document fill its window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import held, lean_rows, let_go
from rowtide.llm.ranges import firsts
from rowtide.llm.tokens import Encoder, id_kind
from rowtide.session import frozen

K1, B = 1.2, 0.75
#: How many neighbours a seed asks for.
NEIGHBOURS = 16
#: The terms that bring a document to its shard.
KEY_TERMS = 3
#: A term that one in so many documents of a shard holds has its weights in a row for all of them.
DENSE = 16
END_ID = 1
#: Texts that are encoded together.
SLICE = 512
#: Under which a worker keeps its encoder, with the words it has met, until it packs.
ENCODER = "encoder"


class Statistics:
    """Documents, mean length and documents by term of a collection."""

    def __init__(self, documents: int, mean: float, df: np.ndarray):
        self.documents, self.mean, self.df = documents, mean, df
        # Terms that documents share: those that enough share to fill a query, rare ones first, then the rarer ones.
        order = np.lexsort((np.arange(len(df)), df, df <= NEIGHBOURS))
        self.order = order[df[order] > 1].astype(np.int32)
        self.rank = np.full(len(df), len(self.order), np.int32)
        self.rank[self.order] = np.arange(len(self.order), dtype=np.int32)

    @classmethod
    def of(cls, documents: list[np.ndarray]) -> Statistics:
        df = np.bincount(np.concatenate([np.unique(ids) for ids in documents]))
        return cls(len(documents), sum(map(len, documents)) / len(documents), df)

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        """Of each document, a row of the rarest terms that enough documents share to fill a query, then the rarer ones; -1 for none."""
        rank, none = self.rank[np.concatenate(documents)], len(self.order)
        sizes = np.array([len(d) for d in documents])
        begins = np.cumsum(sizes) - sizes
        terms, found = np.append(self.order, np.int32(-1)), np.empty((len(documents), KEY_TERMS), np.int32)
        for n in range(KEY_TERMS):
            first = np.minimum.reduceat(rank, begins)
            found[:, n] = terms[first]
            rank[rank == np.repeat(first, sizes)] = none
        return found


class Index:
    """BM25 postings of the documents of one shard, by the statistics of all; terms are token ids."""

    def __init__(self, documents: list[np.ndarray], statistics: Statistics):
        lengths = np.array([len(d) for d in documents], np.float64)
        every = np.concatenate(documents)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], np.repeat(np.arange(len(documents), dtype=np.int32), lengths.astype(np.int64))[order]
        del order
        # Postings by term: whose they are, and how often the document has the term.
        begins = np.flatnonzero(firsts(every, owner))
        count = np.diff(np.append(begins, len(every)))
        term, self.owner = every[begins].astype(np.int64), owner[begins]
        self.documents = documents
        sizes = np.bincount(term)
        self.first = np.r_[0, np.cumsum(sizes)]
        df = statistics.df[:len(sizes)]
        idf = np.log1p((statistics.documents - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * lengths / max(statistics.mean, 1.0))
        tf = count.astype(np.float64)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm[self.owner])
        self.size = len(documents)
        dense = np.flatnonzero(sizes * DENSE > self.size)
        self.row = np.full(len(sizes), -1)
        self.row[dense] = np.arange(len(dense))
        self.rows = np.zeros((len(dense), self.size), np.float32)
        for row, t in enumerate(dense.tolist()):
            part = slice(self.first[t], self.first[t + 1])
            self.rows[row, self.owner[part]] = self.weight[part]
        # A term of one document of the shard leads to no neighbour here.
        self.sparse = (self.row < 0) & (sizes > 1)
        # The documents that the rows stand for.
        self.live = np.arange(self.size)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, scored by all its terms, best first, ties in order.

        What was used once stays used: the rows lose such documents when these are a quarter of them.
        """
        terms = np.sort(self.documents[seed], kind="stable")
        terms = terms[firsts(terms)]
        left = unused[self.live]
        if 4 * np.count_nonzero(left) <= 3 * len(left):
            self.live, self.rows = self.live[left], np.ascontiguousarray(self.rows[:, left])
        rows = self.row[terms]
        dense = np.zeros(len(self.live), np.float32)
        for row in rows[rows >= 0].tolist():
            dense += self.rows[row]
        total = np.zeros(self.size)
        total[self.live] = dense
        parts = [slice(self.first[t], self.first[t + 1]) for t in terms[self.sparse[terms]].tolist()]
        if parts:
            found = np.concatenate([self.owner[p] for p in parts])
            total += np.bincount(found, weights=np.concatenate([self.weight[p] for p in parts]), minlength=self.size)
        docs = np.flatnonzero(unused & (total > 0))
        score = total[docs]
        if len(docs) > NEIGHBOURS:
            # All that tie with the last of the best stay, so that ties are decided by their order.
            best = score >= np.partition(score, len(score) - NEIGHBOURS)[-NEIGHBOURS]
            docs, score = docs[best], score[best]
        return docs[np.argsort(-score, kind="stable")[:NEIGHBOURS]]


class Packer:
    """Fills windows across the shards of a partition; a window stays open from one shard to the next."""

    def __init__(self, window: int, first_sequence: int, statistics: Statistics | None = None):
        self.window, self.sequence, self.filled, self.statistics = window, first_sequence, 0, statistics
        self.open: list[tuple] = []

    def place(self, doc: tuple, start: int) -> Iterator[tuple]:
        """Put a document's ids from ``start`` on; yields pieces of full windows, returns where it stopped."""
        doc_id, ids = doc
        length = min(len(ids) - start, self.window - self.filled)
        self.open.append((doc_id, start, ids[start:start + length], len(ids), self.filled))
        self.filled += length
        if self.filled == self.window:
            yield from self.close()
        return start + length

    def close(self) -> Iterator[tuple]:
        for doc_id, start, ids, whole, offset in self.open:
            yield doc_id, start, len(ids), ids.astype("<u4").tobytes(), whole, self.sequence, offset
        if self.open:
            self.sequence += 1
        self.open, self.filled = [], 0

    def shard(self, documents: list[tuple]) -> Iterator[tuple]:
        texts = [ids for _, ids in documents]
        index = Index(texts, self.statistics or Statistics.of(texts))
        unused = np.ones(len(documents), bool)
        for seed in range(len(documents)):
            if not unused[seed]:
                continue
            waiting = [seed]
            while waiting:
                at = waiting.pop(0)
                if not unused[at]:
                    continue
                unused[at] = False
                start, sequence, fresh = 0, self.sequence, not self.filled
                while start < len(documents[at][1]):
                    start = yield from self.place(documents[at], start)
                if not self.filled:
                    break
                # A document that begins a window, or continues in a new one, is the window's seed.
                if fresh or not waiting or self.sequence != sequence:
                    waiting = index.neighbours(at, unused).tolist()

    def finish(self) -> Iterator[tuple]:
        """The last window, cut into sequences whose lengths are powers of two: these need no padding."""
        left, self.open, self.filled = self.open, [], 0
        total = sum(len(ids) for _, _, ids, _, _ in left)
        for doc_id, start, ids, whole, _ in left:
            while len(ids):
                room = (1 << (total.bit_length() - 1)) - self.filled
                part, ids = ids[:room], ids[room:]
                self.open.append((doc_id, start, part, whole, self.filled))
                self.filled += len(part)
                start += len(part)
                if len(part) == room:
                    total -= self.filled
                    yield from self.close()


def encoded(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, kind: str) -> DataFrame:
    """``doc_id long, ids binary, at long, term array<int>, docs array<int>, times array<long>``: a row for each row of
    ``docs``, whose ``at`` numbers the rows, with gaps, and one without ``at`` for each partition, which counts its
    documents and occurrences by term. Ids are numbers of the type ``kind``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(ENCODER, lambda: Encoder(vocabulary, ranks, pattern, kind))
        if (encode.vocabulary, encode.kind) != (vocabulary, kind):
            let_go(ENCODER)
            encode = held(ENCODER, lambda: Encoder(vocabulary, ranks, pattern, kind))
        end, at = np.array([END_ID], kind).tobytes(), TaskContext.get().partitionId() << 40
        docs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in (big.slice(at, SLICE) for big in batches for at in range(0, big.num_rows, SLICE)):
            ids = [encode(text or "") + end for text in batch["text"].to_pylist()]
            numbers = np.arange(at, at + len(ids))
            at += len(ids)
            texts = [np.frombuffer(i, kind) for i in ids]
            every = np.bincount(np.concatenate(texts))
            if len(every) > len(docs):
                docs, times = (np.pad(x, (0, len(every) - len(x))) for x in (docs, times))
            for text in texts:
                docs[text] += 1  # once for each term, however often the text has it
            times[:len(every)] += every
            yield rows_of(batch["doc_id"], ids, numbers, *[[None] * len(ids)] * 3)
        term = np.flatnonzero(docs)
        yield rows_of([None], [None], [None], [term], [docs[term]], [times[term]])

    def rows_of(*columns) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = ["doc_id", "ids", "at", "term", "docs", "times"]
        return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean_rows(run), "doc_id long, ids binary, at long, term array<int>, docs array<int>, times array<long>"
    )


def counted(rows: DataFrame) -> Statistics:
    """Statistics of all ``rows`` of ``encoded``. The driver gets one row per term of the vocabulary."""
    counts = rows.where("at IS NULL").select(F.explode(F.arrays_zip("term", "docs", "times")).alias("_t"))
    found = counts.groupBy("_t.term").agg(F.sum("_t.docs").alias("docs"), F.sum("_t.times").alias("times")).collect()
    df = np.zeros(1 + max((r["term"] for r in found), default=END_ID), np.int64)
    for r in found:
        df[r["term"]] = r["docs"]
    # Every document holds the end.
    return Statistics(int(df[END_ID]), sum(r["times"] for r in found) / max(1, int(df[END_ID])), df)


def gathered(rows: DataFrame, statistics: Statistics, kind: str) -> DataFrame:
    """``rows (doc_id, ids, at)`` in ranges of their key terms, sorted, so that documents that share these are together."""
    names = [f"key{n}" for n in range(KEY_TERMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(ENCODER)
        for batch in (big.slice(at, SLICE) for big in batches for at in range(0, big.num_rows, SLICE)):
            keys = statistics.keys([np.frombuffer(ids.as_buffer(), kind) for ids in batch["ids"]])
            columns = {name: pa.array(np.ascontiguousarray(column)) for name, column in zip(names, keys.T, strict=True)}
            yield pa.record_batch({"doc_id": batch["doc_id"], "ids": batch["ids"], "at": batch["at"], **columns})

    keyed = rows.mapInArrow(lean_rows(run), "doc_id long, ids binary, at long, " + ", ".join(f"{name} int" for name in names))
    # The row number splits terms that many documents have.
    return keyed.repartitionByRange(*names, "at").sortWithinPartitions(*names, "at").select("doc_id", "ids")


def pack(
    docs: DataFrame, vocabulary: str, ranks: str, pattern: str, window: int = 2048, shard_docs: int = 4096,
    shard_tokens: int = 8_000_000,
) -> DataFrame:
    """Token ids of all ``docs (doc_id, text)``, packed into sequences of ``window`` ids.

    A document is its ids and then id 1. Texts are encoded once and kept on shared storage, two bytes an id
    where the vocabulary allows; documents by term and the mean length are counted over all of them on the way. Then documents are shuffled into the order of their
    rarest shared terms (``Statistics.keys``), and each partition is read in shards of at most ``shard_docs``
    documents or ``shard_tokens`` ids (and one document): a shard gets a BM25 inverted index, the first unused
    document seeds a window, and the index's unused neighbours, by all terms of the seed, fill it, best
    first. A seed finds the documents of its shard, not those with other rarest terms. What does not fit
    continues in the next window. Only the last sequences of a partition are shorter, and their lengths are
    powers of two.

    Returns a row per piece: ``doc_id, start long, length long, ids binary`` (little-endian unsigned 32 bit),
    ``doc_tokens long, sequence_id long, offset long``; sequence ids begin with the partition's number.
    A null text is empty. A null id stays null. Repeated rows are packed each. Empty documents hold id 1.
    An empty table gives no rows. Other columns are ignored.
    """
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    kind = id_kind(vocabulary)
    every = frozen(encoded(docs, vocabulary, ranks, pattern, kind))
    statistics = counted(every)
    rows = every.where("at IS NOT NULL").select("doc_id", "ids", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(ENCODER)
        packer = Packer(window, TaskContext.get().partitionId() << 40, statistics)

        def shards() -> Iterator[list[tuple]]:
            shard, size = [], 0
            for batch in batches:
                for doc_id, held_ids in zip(batch["doc_id"], batch["ids"], strict=True):
                    ids = np.frombuffer(held_ids.as_py(), kind)
                    if shard and (len(shard) == shard_docs or size + len(ids) > shard_tokens):
                        yield shard
                        shard, size = [], 0
                    shard.append((doc_id.as_py(), ids))
                    size += len(ids)
            if shard:
                yield shard

        def pieces() -> Iterator[tuple]:
            for shard in shards():
                yield from packer.shard(shard)
            yield from packer.finish()

        ready = []
        for piece in pieces():
            ready.append(piece)
            if len(ready) == 2000:
                yield batch_of(ready)
                ready = []
        yield batch_of(ready)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return gathered(rows, statistics, kind).mapInArrow(
        lean_rows(run), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
