"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word goes in as a hashed word embedding and the mean of its hashed character n-gram embeddings. The
network reads windows of 32 words, one at every 16th word, so that each overlaps the next by half and every word lies in
two; a document scores as its most toxic window does.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import first_by_hash, released

WORD = re.compile(r"[^\W\d_]+")
WINDOW, STRIDE = 32, 16
WORD_BUCKETS, CHAR_BUCKETS = 1 << 14, 1 << 12
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
#: Share of words hidden in training, and weight decay of embeddings.
HIDDEN_WORDS, DECAY = 0.15, 3e-4
#: Windows that one pass of the network holds.
CHUNK = 2048
#: Texts that are judged together.
SLICE = 512
#: Factors of the byte hashes; any odd numbers would do.
PRIME, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- inputs


@dataclass
class Features:
    """Hashed inputs of distinct words: a word bucket each, and a run of character n-gram buckets."""

    words: np.ndarray
    grams: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, words: list[str]) -> Features:
        joined = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode(), np.uint8).astype(np.uint64)
        begins = np.flatnonzero(joined == 2)
        ends = np.append(begins[1:], len(joined))
        # Character trigrams over the marked word, in bytes; the last two of a word would reach the next one.
        code = (joined[:-2] * PRIME + joined[1:-1]) * PRIME + joined[2:]
        code = (code * MIX) >> np.uint64(40)
        inside = np.ones(len(code), bool)
        for back in (1, 2):
            at = ends - back
            inside[at[at < len(code)]] = False
        kept = np.flatnonzero(inside)
        place = np.arange(len(joined)) - np.repeat(begins, ends - begins)
        powers = np.cumprod(np.full(int(place.max()) + 1, PRIME))
        whole = np.add.reduceat(joined * powers[place], begins)
        return cls(
            ((whole * MIX) >> np.uint64(36)).astype(np.int64) % WORD_BUCKETS,
            (code[kept] % np.uint64(CHAR_BUCKETS)).astype(np.int64),
            np.searchsorted(kept, begins),
        )

    def rows(self, chosen: np.ndarray) -> Features:
        """The features of some words, in that order."""
        stops = np.append(self.starts[1:], len(self.grams))
        counts = (stops - self.starts)[chosen]
        firsts = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) - np.repeat(firsts, counts) + np.repeat(self.starts[chosen], counts)
        return Features(self.words[chosen], self.grams[at], firsts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(np.append(self.starts, len(self.grams)))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def numbered(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the texts' words as numbers one after the other, and where each text starts."""
    number: dict[str, int] = {}
    parts, starts, at = [], [0], 0
    for text in texts:
        words = words_of(text)
        for word in dict.fromkeys(words):
            number.setdefault(word, len(number))
        parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        at += len(words)
        starts.append(at)
    return list(number), np.concatenate(parts) if parts else np.empty(0, np.int32), np.array(starts)


def windows_of(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of the texts: their text, and first and last position; the last window ends its text."""
    lengths = np.diff(starts)
    count = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    owner = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(nth * STRIDE, np.maximum(0, lengths[owner] - WINDOW)) + starts[owner]
    return owner, first, np.minimum(first + WINDOW, starts[owner + 1])


# ---------------------------------------------------------------- network


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Parameters, forward pass and gradients. Arrays of both directions have them as their first axis."""

    p: dict[str, np.ndarray]
    prior: float = 0.0
    moments: dict[str, tuple] = field(default_factory=dict)
    steps: int = 0

    @classmethod
    def fresh(cls, seed: int) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        size = WORD_DIM + CHAR_DIM
        return cls({
            "word": normal(WORD_BUCKETS, WORD_DIM, scale=0.02), "char": normal(CHAR_BUCKETS, CHAR_DIM, scale=0.05),
            "W": normal(2, size, 3 * HIDDEN, scale=size**-0.5), "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "U": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "a": normal(2 * HIDDEN, scale=0.3), "v": normal(2 * HIDDEN, scale=0.3), "c": np.zeros(1, np.float32),
        })

    def inputs(self, words: Features) -> np.ndarray:
        """The input vectors of distinct words."""
        grams = np.add.reduceat(self.p["char"][words.grams], words.starts, axis=0) / words.counts[:, None]
        return np.concatenate([self.p["word"][words.words], grams.astype(np.float32)], axis=1)

    def forward(self, gates: np.ndarray, at: np.ndarray, kept: list | None = None) -> tuple[np.ndarray, tuple]:
        """Logits of windows. ``gates``: (2, words + 1, 3H) projected inputs; ``at``: (windows, WINDOW), last row: padding."""
        n, length = at.shape
        U = self.p["U"]
        state = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((2, length, n, HIDDEN), np.float32)
        real = (at < gates.shape[1] - 1).astype(np.float32)
        for t in range(length):
            back = length - 1 - t
            x = np.stack([gates[0, at[:, t]], gates[1, at[:, back]]])
            u = state @ U
            zr = sigmoid(x[..., :2 * HIDDEN] + u[..., :2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            new = np.tanh(x[..., 2 * HIDDEN:] + r * u[..., 2 * HIDDEN:])
            live = np.stack([real[:, t], real[:, back]])[..., None]
            following = state + live * (1 - z) * (new - state)
            if kept is not None:
                kept.append((state, z, r, new, u[..., 2 * HIDDEN:], live))
            state = following
            states[0, t], states[1, back] = state[0], state[1]
        both = np.concatenate([states[0], states[1]], axis=2)
        energy = both @ self.p["a"] - 1e9 * (1 - real.T)
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[..., None] * both).sum(axis=0)
        return pooled @ self.p["v"] + self.p["c"][0], (both, weight, pooled)

    def gates_of(self, inputs: np.ndarray) -> np.ndarray:
        gates = inputs[None] @ self.p["W"] + self.p["b"]
        return np.concatenate([gates, np.zeros((2, 1, 3 * HIDDEN), np.float32)], axis=1)

    def scores(self, gates: np.ndarray, ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Probabilities of windows of a run of word numbers."""
        out = np.empty(len(first), np.float32)
        for a in range(0, len(first), CHUNK):
            out[a:a + CHUNK] = self.forward(gates, spread(ids, first[a:a + CHUNK], last[a:a + CHUNK], gates.shape[1] - 1))[0]
        return sigmoid(out.astype(np.float64))

    def learn(self, words: Features, at: np.ndarray, labels: np.ndarray, rate: float) -> None:
        """One step of Adam on the logistic loss of some windows."""
        n = len(at)
        inputs = self.inputs(words)
        kept: list = []
        logits, (both, weight, pooled) = self.forward(self.gates_of(inputs), at, kept)
        d_logit = ((sigmoid(logits) - labels) / n).astype(np.float32)
        g = {"v": pooled.T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["v"]
        d_weight = (both * d_pooled).sum(axis=2)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["a"] = np.tensordot(d_energy, both, axes=([0, 1], [0, 1]))
        d_both = weight[..., None] * d_pooled + d_energy[..., None] * self.p["a"]
        d_states = np.stack([d_both[..., :HIDDEN], d_both[..., HIDDEN:]])
        U = self.p["U"]
        g["U"] = np.zeros_like(U)
        d_gates = np.zeros((2, len(inputs) + 1, 3 * HIDDEN), np.float32)
        d_state = np.zeros((2, n, HIDDEN), np.float32)
        length = at.shape[1]
        for t in reversed(range(length)):
            back = length - 1 - t
            state, z, r, new, u_new, live = kept[t]
            d = d_state + np.stack([d_states[0, t], d_states[1, back]])
            d_live = d * live
            d_new = d_live * (1 - z) * (1 - new * new)
            d_z = d_live * (state - new) * z * (1 - z)
            d_r = d_new * u_new * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=2)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=2)
            g["U"] += state.transpose(0, 2, 1) @ d_u
            d_state = d * (1 - live) + d_live * z + d_u @ U.transpose(0, 2, 1)
            np.add.at(d_gates[0], at[:, t], d_x[0])
            np.add.at(d_gates[1], at[:, back], d_x[1])
        d_gates = d_gates[:, :-1]
        g["W"] = inputs.T[None] @ d_gates
        g["b"] = d_gates.sum(axis=1, keepdims=True)
        d_inputs = (d_gates @ self.p["W"].transpose(0, 2, 1)).sum(axis=0)
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], words.words, d_inputs[:, :WORD_DIM])
        np.add.at(g["char"], words.grams, np.repeat(d_inputs[:, WORD_DIM:] / words.counts[:, None], words.counts, axis=0))
        self.step(g, rate)

    def step(self, gradients: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        for name, g in gradients.items():
            g = g + DECAY * self.p[name] if name in ("W", "U", "word", "char") else g
            m, s = self.moments.get(name, (np.zeros_like(g), np.zeros_like(g)))
            m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
            self.moments[name] = m, s
            self.p[name] -= (rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.99**self.steps)) + 1e-6)).astype(np.float32)


def spread(ids: np.ndarray, first: np.ndarray, last: np.ndarray, padding: int) -> np.ndarray:
    at = first[:, None] + np.arange(WINDOW)
    inside = at < last[:, None]
    return np.where(inside, ids[np.minimum(at, len(ids) - 1)], padding)


def evidence(buckets: np.ndarray, owner: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log-odds of a toxic text for the texts that hold each word bucket, shrunk where these are few."""
    pairs = np.unique(owner.astype(np.int64) * WORD_BUCKETS + buckets)
    held = y[pairs // WORD_BUCKETS] == 1
    bucket = pairs % WORD_BUCKETS
    bad, good = (np.bincount(bucket[m], minlength=WORD_BUCKETS) for m in (held, ~held))
    odds = np.log((bad + 0.5) / ((y == 1).sum() + 1)) - np.log((good + 0.5) / ((y == 0).sum() + 1))
    return (odds * (bad + good) / (bad + good + 5.0)).astype(np.float32)


def trained(texts: list[str], labels: list[int], steps: int = 400, batch: int = 128, rate: float = 0.01, seed: int = 3) -> Network:
    """A network for labelled texts.

    A text's label holds for its most toxic window. So each epoch learns from every text's highest
    window, and from a random one of clean texts.
    """
    network = Network.fresh(seed)
    rng = np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    network.prior = float(y.mean()) if len(y) else 0.0
    words, ids, starts = numbered(texts)
    owner, first, last = windows_of(starts)
    if not len(owner) or y.min() == y.max():
        return network
    features = Features.of(words)
    begins = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
    counts = np.diff(np.r_[begins, len(owner)])
    label = y[owner[begins]]
    # Every sixth text of each label only tells when to stop.
    kept_back = np.zeros(len(begins), bool)
    for value in (0, 1):
        kept_back[np.flatnonzero(label == value)[5::6]] = True
    toxic, clean = np.flatnonzero((label == 1) & ~kept_back), np.flatnonzero((label == 0) & ~kept_back)
    text_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    shown = np.isin(text_of, owner[begins[~kept_back]])
    odds = evidence(features.words[ids[shown]], text_of[shown], y)
    network.p["word"][:, 0] += 0.3 * odds
    weights = np.append(0.0, np.cumsum(np.maximum(odds[features.words[ids]], 0.0)))
    # Windows of toxic texts are repeated until they are about a third of what an epoch learns from.
    times = max(1, len(clean) // max(1, len(toxic)))
    batch = min(batch, max(16, len(begins) // 8))
    epochs = max(6, -(-steps * batch // (3 * len(begins))))
    best, least = dict(network.p), np.inf
    for epoch in range(epochs + 1):
        chance = begins + (rng.random(len(begins)) * counts).astype(np.int64)
        if epoch == 0:
            score = weights[last] - weights[first]
        else:
            score = network.scores(network.gates_of(network.inputs(features)), ids, first, last)
        top = np.lexsort((score, owner))[begins + counts - 1]
        if epoch:
            said = np.clip(np.where(label == 1, score[top], 1 - score[top])[kept_back], 0.01, 1)
            loss = -np.log(said).mean() if kept_back.any() else -epoch
            if loss < least:
                best, least = {k: v.copy() for k, v in network.p.items()}, loss
        if epoch == epochs:
            break
        chosen = np.r_[top[clean], chance[clean], np.repeat(top[toxic], times)]
        for a in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
            at = spread(ids, first[a], last[a], len(words))
            # Some words are hidden, so that no text is learned by a single rare one.
            at[rng.random(at.shape) < HIDDEN_WORDS] = len(words)
            used, place = np.unique(at, return_inverse=True)
            place = place.reshape(at.shape)
            if used[-1] == len(words):
                used = used[:-1]
            if len(used):
                network.learn(features.rows(used), place, y[owner[a]], rate * (0.5 if epoch >= epochs // 2 else 1.0))
    network.p, network.moments = best, {}
    return network


# ---------------------------------------------------------------- Spark


def learned(docs: DataFrame, labels: DataFrame, sample: int = 1500, longest: int = 20_000, seed: int = 3) -> Network:
    """A network for ``docs (doc_id, text)`` as ``labels (doc_id, toxic)`` mark them.

    Trained on the driver on a bounded sample: of each label the documents that come first by a hash of
    their id, ``sample`` toxic and twice as many clean ones, of at most ``longest`` characters each.
    Rows without id, text or label are not learned from; of a repeated id the first text in order counts, once a label.
    """
    marked = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    short = docs.where(F.length("text").between(1, longest)).select("doc_id")
    limits = F.when(F.col("toxic") == 1, sample).otherwise(2 * sample)
    drawn = first_by_hash(marked.join(short, "doc_id", "left_semi"), "toxic", limits, seed)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").where(F.length("text").between(1, longest))
    # No more rows than the sample, however often an id repeats.
    rows = texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["text"]))
    return trained([r["text"] for r in rows], [r["toxic"] for r in rows], seed=seed)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def judged(network: Network, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of windows and first word of the highest one (-1: none) of each text."""
    words, ids, starts = numbered(texts)
    owner, first, last = windows_of(starts)
    count = np.bincount(owner, minlength=len(texts))
    best, worst = np.full(len(texts), network.prior), np.full(len(texts), -1)
    if len(owner):
        found = network.scores(network.gates_of(network.inputs(Features.of(words))), ids, first, last)
        begins = np.flatnonzero(np.r_[True, np.diff(owner) > 0])
        best[owner[begins]] = np.maximum.reduceat(found, begins)
        top = np.lexsort((-first, found, owner))[np.r_[begins[1:], len(owner)] - 1]
        worst[owner[top]] = first[top] - starts[owner[top]]
    return best, count, worst


def score(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, score double, windows long, worst long`` of each document of ``docs (doc_id, text)``.

    Windows at every STRIDE-th word of the whole text are scored; ``worst`` is the number (from 0) of the first
    word of the highest one, null where there is none. A text without words, or a null one, scores the share of
    toxic texts that was learned from. Repeated rows are scored each; a null id stays null; an empty
    table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            best, count, worst = judged(network, batch["text"].to_pylist())
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "score": pa.array(best, pa.float64()), "windows": pa.array(count, pa.int64()),
                "worst": pa.array(worst, pa.int64(), mask=worst < 0),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, score double, windows long, worst long"
    )


def kept(docs: DataFrame, network: Network, below: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below a bar; cases as in ``score``."""

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Only texts travel to Python, and only scores come back.
        for every in texts:
            found = [judged(network, every.slice(at, SLICE).to_pylist())[0] for at in range(0, len(every), SLICE)]
            yield pa.array(np.concatenate(found) if found else [], pa.float64())
            released()

    return docs.where(scored("text") < below)
