"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a word are an embedding of the word and the mean embedding of its character
n-grams, both hashed. Two gated recurrent layers read a window of words in both directions,
attention weighs their states, and a linear unit gives the window's score. A text is scored
by its highest window, over all overlapping windows of the whole text.

Training sees labelled texts only through a label per text: in each round every window of
the sample is scored, and the highest ones stand for their texts. The sample is bounded by
``Params``; scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import fold, texts_of

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Params:
    """``max_toxic``, ``max_clean``, ``max_chars``: labelled texts that training takes, and how
    long they may be. Everything else is the network's size and training."""

    window: int = 32
    stride: int = 16
    word_buckets: int = 1 << 15
    gram_buckets: int = 1 << 14
    dim: int = 12
    hidden: int = 12
    attention: int = 8
    max_toxic: int = 1200
    max_clean: int = 2400
    max_chars: int = 20_000
    rounds: int = 5
    batch: int = 128
    rate: float = 0.01
    cache: int = 150_000
    seed: int = 5


def features(word: str, p: Params) -> tuple[int, list[int]]:
    """Buckets of a word and of its character n-grams of three and four bytes, bounds marked."""
    raw = b"<" + word.encode("utf-8", "replace") + b">"
    grams = [zlib.crc32(raw[i : i + n]) % p.gram_buckets for n in (3, 4) for i in range(len(raw) - n + 1)]
    return zlib.crc32(raw) % p.word_buckets, grams or [zlib.crc32(raw) % p.gram_buckets]


def _crc_table() -> np.ndarray:
    """What each byte adds to the usual 32-bit checksum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(raw: np.ndarray, n: int) -> np.ndarray:
    """``zlib.crc32`` of the ``n`` bytes from every place of ``raw`` on, as far as they reach."""
    count = max(0, len(raw) - n + 1)
    crc = np.full(count, 0xFFFFFFFF, np.uint32)
    for k in range(n):
        crc = _CRC[(crc ^ raw[k : k + count]) & 255] ^ (crc >> 8)
    return ~crc


class Features:
    """Feature buckets of a list of distinct words, flat; those of ``features`` in their order."""

    def __init__(self, words: list[str], p: Params):
        raws = [b"<%b>" % w.encode("utf-8", "replace") for w in words]
        self.word = np.array([zlib.crc32(r) for r in raws], np.int64) % p.word_buckets
        length = np.array([len(r) for r in raws], np.int64)
        first = np.cumsum(length) - length
        raw = np.frombuffer(b"".join(raws), np.uint8)
        # a word has its grams of three bytes first, then those of four
        threes = length - 2
        self.sizes = threes + np.maximum(length - 3, 0)
        self.starts = np.cumsum(self.sizes) - self.sizes
        at = np.arange(int(self.sizes.sum())) - np.repeat(self.starts, self.sizes)
        ahead = np.repeat(threes, self.sizes)
        short = at < ahead
        place = np.repeat(first, self.sizes) + np.where(short, at, at - ahead)
        four = np.append(checksums(raw, 4), np.uint32(0))
        grams = np.where(short, checksums(raw, 3)[place], four[np.minimum(place, len(four) - 1)])
        self.gram = grams.astype(np.int64) % p.gram_buckets


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.float32(1) + np.tanh(np.float32(0.5) * x))


def window_starts(n: int, p: Params) -> range:
    """Starts of the overlapping windows of n words; the last one reaches the end."""
    return range(0, max(1, n - p.window + p.stride), p.stride) if n else range(0)


class Network:
    """Weights, forward pass and gradients. A window is a row of word numbers and a length."""

    def __init__(self, p: Params):
        rng = np.random.default_rng(p.seed)
        make = lambda *shape, scale=0.1: rng.normal(0, scale, shape).astype(np.float32)
        h, d = p.hidden, 2 * p.dim
        self.p = p
        self.weights = {
            "word": make(p.word_buckets, p.dim), "gram": make(p.gram_buckets, p.dim),
            "inputs": make(d, 6 * h, scale=d**-0.5), "bias": np.zeros(6 * h, np.float32),
            "forth": make(h, 3 * h, scale=h**-0.5), "back": make(h, 3 * h, scale=h**-0.5),
            "look": make(2 * h, p.attention, scale=0.2), "weigh": make(p.attention, scale=0.5),
            "out": make(2 * h, scale=0.3), "offset": np.zeros(1, np.float32),
        }

    def embed(self, f: Features) -> np.ndarray:
        w = self.weights
        grams = np.add.reduceat(w["gram"][f.gram], f.starts) / f.sizes[:, None].astype(np.float32)
        return np.concatenate([w["word"][f.word], grams], axis=1)

    def gates(self, f: Features) -> np.ndarray:
        """What each word adds to the gates of both directions."""
        return self.embed(f) @ self.weights["inputs"] + self.weights["bias"]

    def _read(self, gates, ids, mask, recur, steps, keep):
        h = self.p.hidden
        state = np.zeros((len(ids), h), np.float32)
        out, saved = np.empty((len(ids), ids.shape[1], h), np.float32), []
        for t in steps:
            x = gates[ids[:, t]]
            hu = state @ recur
            zr = sigmoid(x[:, : 2 * h] + hu[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * hu[:, 2 * h :])
            after = new + z * (state - new)
            if mask is not None:
                m = mask[:, t, None]
                after = np.where(m, after, state)
            if keep:
                saved.append((t, state, z, r, new, hu[:, 2 * h :]))
            state = after
            out[:, t] = state
        return out, saved

    def forward(self, gates: np.ndarray, ids: np.ndarray, lengths: np.ndarray, keep: bool = False):
        """Scores of windows as logits; with ``keep`` also what the gradients need."""
        w, h = self.weights, self.p.hidden
        size = ids.shape[1]
        full = bool((lengths == size).all())
        mask = None if full else np.arange(size)[None, :] < lengths[:, None]
        forth, saved_f = self._read(gates[:, : 3 * h], ids, mask, w["forth"], range(size), keep)
        back, saved_b = self._read(gates[:, 3 * h :], ids, mask, w["back"], range(size - 1, -1, -1), keep)
        states = np.concatenate([forth, back], axis=2)
        looked = np.tanh(states @ w["look"])
        scores = looked @ w["weigh"]
        if mask is not None:
            scores = np.where(mask, scores, np.float32(-1e9))
        share = np.exp(scores - scores.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        pooled = np.matmul(share[:, None, :], states)[:, 0]
        logits = pooled @ w["out"] + w["offset"][0]
        return (logits, (mask, states, looked, share, pooled, saved_f, saved_b)) if keep else logits

    def _unread(self, d_states, ids, mask, recur, saved, d_gates):
        """Back through time; adds to ``d_gates`` (words, 3 h) and returns the recurrent gradient."""
        d_recur, d_state = np.zeros_like(recur), np.zeros_like(saved[0][1])
        for t, before, z, r, new, hun in reversed(saved):
            d = d_state + d_states[:, t]
            passed = 0
            if mask is not None:
                m = mask[:, t, None]
                d, passed = np.where(m, d, 0), np.where(m, 0, d)
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * hun * r * (1 - r)
            d_h = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_recur += before.T @ d_h
            np.add.at(d_gates, ids[:, t], np.concatenate([d_z, d_r, d_new], axis=1))
            d_state = d * z + passed + d_h @ recur.T
        return d_recur

    def gradients(self, f: Features, ids: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict:
        w, h, p = self.weights, self.p.hidden, self.p
        embedded = self.embed(f)
        gates = embedded @ w["inputs"] + w["bias"]
        logits, (mask, states, looked, share, pooled, saved_f, saved_b) = self.forward(gates, ids, lengths, keep=True)
        d_logit = ((sigmoid(logits) - labels) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "offset": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * w["out"]
        d_share = (states @ d_pooled[:, :, None])[:, :, 0]
        d_scores = share * (d_share - (share * d_share).sum(1, keepdims=True))
        d_looked = d_scores[:, :, None] * w["weigh"] * (1 - looked * looked)
        g["weigh"] = (looked * d_scores[:, :, None]).sum((0, 1))
        g["look"] = np.tensordot(states, d_looked, ([0, 1], [0, 1]))
        d_states = share[:, :, None] * d_pooled[:, None, :] + d_looked @ w["look"].T
        d_gates = np.zeros_like(gates)
        forth, back = np.zeros((len(gates), 3 * h), np.float32), np.zeros((len(gates), 3 * h), np.float32)
        g["forth"] = self._unread(d_states[:, :, :h], ids, mask, w["forth"], saved_f, forth)
        g["back"] = self._unread(d_states[:, :, h:], ids, mask, w["back"], saved_b, back)
        d_gates = np.concatenate([forth, back], axis=1)
        g["inputs"], g["bias"] = embedded.T @ d_gates, d_gates.sum(0)
        d_embedded = d_gates @ w["inputs"].T
        g["word"], g["gram"] = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
        np.add.at(g["word"], f.word, d_embedded[:, : p.dim])
        np.add.at(g["gram"], f.gram, np.repeat(d_embedded[:, p.dim :] / f.sizes[:, None], f.sizes, axis=0))
        return g


class Lexicon:
    """Words met so far and their gate inputs, emptied when it is full."""

    def __init__(self, net: Network):
        self.net, self.place = net, {}
        self.gates = np.zeros((0, 6 * net.p.hidden), np.float32)

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.place) > self.net.p.cache:
            self.place.clear()
            self.gates = self.gates[:0]
        new = [w for w in dict.fromkeys(words) if w not in self.place]
        if new:
            for k in range(0, len(new), 20_000):
                self.gates = np.concatenate([self.gates, self.net.gates(Features(new[k : k + 20_000], self.net.p))])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))


def windows(sizes: list[int], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of consecutive texts with so many words: each window's text, first word and length."""
    owner, first, length = [], [], []
    base = 0
    for i, n in enumerate(sizes):
        starts = window_starts(n, p)
        owner += [i] * len(starts)
        first += [base + s for s in starts]
        length += [min(p.window, n - s) for s in starts]
        base += n
    return np.array(owner, np.int64), np.array(first, np.int64), np.array(length, np.int64)


def window_ids(rows: np.ndarray, first: np.ndarray, p: Params) -> np.ndarray:
    """Word numbers of windows; what reaches over the end is masked by the length."""
    at = np.minimum(first[:, None] + np.arange(p.window)[None, :], len(rows) - 1)
    return rows[at]


def logits_of(net: Network, gates: np.ndarray, rows: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = np.empty(len(first), np.float32)
    whole = length == net.p.window
    for chosen in (np.flatnonzero(whole), np.flatnonzero(~whole)):
        for k in range(0, len(chosen), 1024):
            at = chosen[k : k + 1024]
            out[at] = net.forward(gates, window_ids(rows, first[at], net.p), length[at])
    return out


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Model:
    """``base``: score of a text without words. A score is the logistic of ``slope * (logit - cut)``."""

    net: Network | None
    base: float
    cut: float = 0.0
    slope: float = 1.0

    def scores(self, texts: list[str], lexicon: Lexicon | None) -> list[float]:
        out = [self.base] * len(texts)
        if self.net is None:
            return out
        held: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            words = [w for _, ws in held for w in ws]
            owner, first, length = windows([len(ws) for _, ws in held], self.net.p)
            rows = lexicon.rows(words)
            logits = logits_of(self.net, lexicon.gates, rows, first, length)
            best = np.full(len(held), -np.inf, np.float32)
            np.maximum.at(best, owner, logits)
            for (i, _), value in zip(held, sigmoid(np.float32(self.slope) * (best - np.float32(self.cut)))):
                out[i] = float(value)

        for i, text in enumerate(texts):
            found = split_words(text)
            if not found:
                continue
            held.append((i, found))
            size += len(found)
            if size > 60_000:
                flush()
                held, size = [], 0
        if held:
            flush()
        return out


def log_odds(bucket: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Of each bucket: smoothed log ratio of the shares of toxic and clean texts that hold it."""
    counts = np.zeros((2, size))
    for b, y in zip(bucket, labels):
        counts[int(y), np.unique(b)] += 1
    n = np.array([(labels == 0).sum(), (labels == 1).sum()])
    share = (counts + 0.5) / (n[:, None] + 1)
    return np.clip(np.log(share[1] / share[0]), -4, 4).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, prior: float, p: Params) -> Model:
    """Train on labelled texts. A quarter of them sets the cut between the classes."""
    found = [split_words(t) for t in texts]
    use = np.array([len(w) > 0 for w in found], bool)
    found, labels = [w for w, u in zip(found, use) if u], labels[use]
    if len(set(labels.tolist())) < 2:
        return Model(None, min(max(prior, 0.0), 1.0))
    net = Network(p)
    place = {w: i for i, w in enumerate(dict.fromkeys(w for ws in found for w in ws))}
    f = Features(list(place), p)
    rows = np.array([place[w] for ws in found for w in ws], np.int64)
    sizes = [len(ws) for ws in found]
    owner, first, length = windows(sizes, p)
    rng = np.random.default_rng(p.seed)
    tested = rng.random(len(found)) < 0.25
    bounds = np.cumsum(sizes) - sizes
    own = [rows[b : b + n] for b, n in zip(bounds, sizes)]
    train_own = [r for r, t in zip(own, tested) if not t]
    word_odds = log_odds([f.word[r] for r in train_own], labels[~tested], p.word_buckets)
    gram_of = lambda r: np.concatenate([f.gram[f.starts[k] : f.starts[k] + f.sizes[k]] for k in np.unique(r)])
    gram_odds = log_odds([gram_of(r) for r in train_own], labels[~tested], p.gram_buckets)
    # embeddings start from how much a feature tells the classes apart
    net.weights["word"][:, 0] += word_odds / 2
    net.weights["gram"][:, 0] += gram_odds / 2
    hint = word_odds[f.word] + np.add.reduceat(gram_odds[f.gram], f.starts) / f.sizes
    at = window_ids(rows, first, p)
    value = np.where(np.arange(p.window)[None, :] < length[:, None], hint[at], -np.inf).max(1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    step = 0
    trained = ~tested[owner]
    for round_ in range(p.rounds):
        if round_:
            value = logits_of(net, net.gates(f), rows, first, length)
        noisy = value + rng.random(len(value)) * 1e-6
        order = np.lexsort((-noisy, owner))
        rank = np.arange(len(order)) - np.repeat(np.flatnonzero(np.diff(owner[order], prepend=-1)), np.bincount(owner)[np.unique(owner)])
        top = np.zeros(len(owner), np.int64)
        top[order] = rank
        y = labels[owner]
        chosen = np.flatnonzero(trained & (((y == 1) & (top < 1)) | ((y == 0) & ((top < 2) | (rng.random(len(y)) < 0.05)))))
        rng.shuffle(chosen)
        balance = max(1.0, (y[chosen] == 0).sum() / max(1, (y[chosen] == 1).sum()) / 2)
        for k in range(0, len(chosen), p.batch):
            pick = chosen[k : k + p.batch]
            ids = window_ids(rows, first[pick], p)
            unique, ids = np.unique(ids, return_inverse=True)
            part = _subset(f, unique)
            weight = np.where(y[pick] == 1, balance, 1.0)
            g = net.gradients(part, ids.reshape(len(pick), -1), length[pick], y[pick].astype(np.float32), weight)
            step += 1
            _adam(net.weights, g, moments, step, p.rate)
    logits = logits_of(net, net.gates(f), rows, first, length)
    best = np.full(len(found), -np.inf)
    np.maximum.at(best, owner, logits)
    cut, slope = choose_cut(best[tested], labels[tested], prior) if len(set(labels[tested].tolist())) == 2 else choose_cut(best, labels, prior)
    return Model(net, min(max(prior, 0.0), 1.0), cut, slope)


def _subset(f: Features, at: np.ndarray) -> Features:
    part = Features.__new__(Features)
    part.word, part.sizes = f.word[at], f.sizes[at]
    part.starts = np.cumsum(part.sizes) - part.sizes
    within = np.arange(part.sizes.sum()) - np.repeat(part.starts, part.sizes)
    part.gram = f.gram[np.repeat(f.starts[at], part.sizes) + within]
    return part


def _adam(weights: dict, g: dict, moments: dict, step: int, rate: float) -> None:
    for k, v in weights.items():
        m, s = moments[k]
        m += np.float32(0.1) * (g[k] - m)
        s += np.float32(0.01) * (g[k] * g[k] - s)
        v -= np.float32(rate / (1 - 0.9**step)) * m / (np.sqrt(s / np.float32(1 - 0.99**step)) + np.float32(1e-7))


def choose_cut(logits: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """The cut with the fewest errors at the population's share of toxic texts, and a slope.

    Among equally good cuts the middle of the widest gap is taken.
    """
    order = np.argsort(logits)
    x, y = logits[order], labels[order]
    prior = min(max(prior, 0.01), 0.99)
    miss = np.concatenate([[0], np.cumsum(y == 1)]) / max(1, (y == 1).sum()) * prior
    alarm = np.concatenate([(y == 0).sum() - np.concatenate([[0], np.cumsum(y == 0)])]) / max(1, (y == 0).sum()) * (1 - prior)
    error = miss + alarm
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = edges[1:] - edges[:-1]
    best = np.flatnonzero(error <= error.min() + 1e-12)
    k = best[np.argmax(gaps[best])]
    spread = max(1e-3, float(np.std(x)))
    return float((edges[k] + edges[k + 1]) / 2), min(4.0, 2.0 / spread)


def sample(docs: DataFrame, labels: DataFrame, p: Params) -> tuple[list[str], np.ndarray, float]:
    """A bounded sample of labelled texts drawn by a hash of the id, and the share of toxic labels."""
    per_doc = labels.groupBy("id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    totals = {r.toxic: r["count"] for r in per_doc.groupBy("toxic").count().collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    draw = F.xxhash64(F.lit(p.seed), "id")
    parts = [
        per_doc.where(F.col("toxic") == y).orderBy(draw, "id").limit(n) for y, n in ((1, p.max_toxic), (0, p.max_clean))
    ]
    chosen = F.broadcast(parts[0].union(parts[1]))
    near = docs.join(chosen, "id").where(F.length("text") <= p.max_chars)
    # one row an id, so that repeated ids neither add rows nor leave them to chance
    found = near.groupBy("id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).select("text", "toxic").collect()
    found.sort(key=lambda r: (r.toxic, r.text))
    return [r.text for r in found], np.array([r.toxic for r in found], np.int64), prior


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "toxic",
    parts: int = 5,
    held_out: int = 0,
    params: Params | None = None,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted``.

    Learns from labels of ids whose crc32 modulo ``parts`` is not ``held_out`` (a null id
    counts as empty text). A null text, or one without a word, gets the share of toxic
    labels as its score; without labels of both kinds every text does. A document
    labelled twice is toxic if one label says so. All windows of a text of any length are
    scored, and equal texts score alike, so repeated rows do. Other columns are left out; an
    empty table gives an empty result.
    """
    p = params or Params()
    taken = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    known = labels.where(fold(label_id, parts) != held_out).select(F.col(label_id).alias("id"), F.col(label).cast("int").alias("toxic"))
    model = fit(*sample(taken.where(F.col("text").isNotNull()), known.where(F.col("id").isNotNull()), p), p)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lexicon = Lexicon(m.net) if m.net is not None else None
        for batch in batches:
            scores = m.scores(texts_of(batch), lexicon)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = taken.schema["id"].dataType.simpleString()
    scored = taken.mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(doc_id), (fold("id", parts) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
