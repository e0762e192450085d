"""Scoring texts by a log-bilinear language model trained with noise-contrastive estimation.

Tokens are words with A-Z lower-cased, and one end per text. A token's probability has two
factors. The first is that of its class, from the classes of the two tokens before it: the
commonest words are classes of their own, all other words share ``rest`` classes by their
ending. The second is that of the word within such a class, from the two words before it: every
word above a count threshold has a vector as a target and one as a context, and the words
below it are one more target, in which a word has its smoothed relative frequency. Both factors
are softmaxes over all their targets, so the probabilities of all tokens sum to one.

What is learnt covers all training texts. Word counts, and counts of class triples, at most
``classes ** 3`` numbers, are sums in Spark; from the triples the driver trains the classes.
Word vectors are trained in the tasks that read the texts for the triples: each starts from the
relative frequencies, learns from all its texts, and the tasks' vectors are averaged by the tokens
they saw. Training so grows with the input, and no task or driver holds more than the vectors.

A scoring task knows the words above the threshold, ``1 / hot_share`` at most. Other words
meet their counts in one join.
"""

from __future__ import annotations

import copy
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import cut_words, fold, lowered_words, numbers_in, rows, stored, stretches  # noqa: F401

SMOOTH = 0.1


@dataclass(frozen=True)
class Params:
    """``classes`` counts words of their own, ``rest`` classes, end and begin. ``hot_share``:
    words at least so common have vectors, ``1 / hot_share`` at most. ``dim``, ``steps``,
    ``batch``, ``noise``, ``rate``: size and training of the classes' model; ``word_...`` of the
    words', which learn from the part ``learn`` of all training texts, by default from all. ``piece``:
    bytes of texts that are counted or scored together; ``lesson``: that are learnt from in
    one random order."""

    classes: int = 128
    rest: int = 24
    hot_share: float = 5e-5
    dim: int = 24
    steps: int = 2000
    batch: int = 2048
    noise: int = 64
    rate: float = 0.15
    learn: float = 1.0
    word_dim: int = 16
    word_noise: int = 8
    word_batch: int = 1024
    word_rate: float = 0.05
    piece: int = 2_000_000
    lesson: int = 1_250_000
    seed: int = 11

    @property
    def own(self) -> int:
        return self.classes - self.rest - 2

    @property
    def end(self) -> int:
        return self.classes - 2

    @property
    def begin(self) -> int:
        return self.classes - 1


#: Bytes as words have them, A-Z lower-cased; white space is a blank.
_WORDS = bytes(32 if b in b"\t\n\r\v\f " else b + 32 if 65 <= b <= 90 else b for b in range(256))


@cache
def ending_classes(rest: int) -> np.ndarray:
    """crc32 modulo ``rest`` of every two bytes, in their order, then of every single byte."""
    endings = chain((bytes((a, b)) for a in range(256) for b in range(256)), (bytes((b,)) for b in range(256)))
    return np.fromiter((zlib.crc32(e) % rest for e in endings), np.int64, 257 * 256)


class Classes:
    """Numbers and classes of words; a word without a number has -1 and the class of its ending.

    ``known`` starts with the words that are classes of their own, in that order.
    """

    def __init__(self, known: list[bytes], params: Params):
        self.known, self.params = pa.array(known, pa.binary()), params
        self.own = np.append(self._of_endings(self.known), -1)
        self.own[: min(params.own, len(known))] = np.arange(min(params.own, len(known)))

    def _of_endings(self, found: pa.Array) -> np.ndarray:
        """The rest classes of words, by the crc32 of their last two bytes."""
        ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1]
        if not len(found):
            return np.zeros(0, np.int64)
        data = np.frombuffer(found.buffers()[2], np.uint8)
        last, before = data[ends[1:] - 1].astype(np.int64), data[ends[1:] - 2]
        return self.params.own + ending_classes(self.params.rest)[np.where(np.diff(ends) > 1, before * np.int64(256), 65536) + last]

    def of(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number and class of every word."""
        number = numbers_in(found, self.known)
        found_class = self.own[number]
        unknown = number < 0
        found_class[unknown] = self._of_endings(found)[unknown]
        return number, found_class


def after_two(flat: np.ndarray, sizes: np.ndarray, begin: int, tail: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The texts' values with two times ``begin`` before each text and ``tail`` more after it, and where their own stand."""
    starts = np.arange(len(sizes)) * (2 + tail) + 2
    at = np.arange(len(flat)) + np.repeat(starts, sizes)
    out = np.full(len(flat) + len(sizes) * (2 + tail), begin, np.int64)
    out[at] = flat
    return out, at


def triples(found_class: np.ndarray, sizes: np.ndarray, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """Codes of (before last, last, token) for every token and end, and their text's number.

    Texts of ``sizes`` words stand one after another.
    """
    flat, at = after_two(found_class, sizes, params.begin, 1)
    ends = np.cumsum(sizes + 3) - 1
    flat[ends] = params.end
    at, texts = np.concatenate([at, ends]), np.arange(len(sizes))
    return (flat[at - 2] * params.classes + flat[at - 1]) * params.classes + flat[at], np.concatenate([np.repeat(texts, sizes), texts])


def word_counts(texts: DataFrame, params: Params) -> DataFrame:
    """(word, n) over all texts: counted piece by piece, then summed."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    piece = params.piece

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, _ in pieces_of(batch.column("text"), piece):
                counted = words.value_counts()
                yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], schema=schema)

    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def pieces_of(texts: pa.Array, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of consecutive texts of about ``size`` bytes, and how many each text has."""
    for low, high in stretches(texts, size):
        yield cut_words(texts.slice(low, high - low), _WORDS)


class WordModel:
    """Words within the classes of the rest.

    A target is a word's number, or ``words + e`` for all words of rest class e that have
    none. A context is a target, or ``begin``. Scores are the target's log frequency in its
    class plus its vector's product with the context's, and are normalised within the class.
    """

    def __init__(self, classes: np.ndarray, weight: np.ndarray, rest_mass: np.ndarray, params: Params):
        self.params, self.words = params, len(classes)
        self.kind = np.concatenate([classes - params.own, np.arange(params.rest)])  # below 0: a class of its own
        self.weight = np.concatenate([weight, rest_mass])
        members = np.flatnonzero(self.kind >= 0)
        self.members = members[np.argsort(self.kind[members], kind="stable")]
        kinds = self.kind[self.members]
        self.bounds = np.searchsorted(kinds, np.arange(params.rest + 1))
        self.local = np.zeros(len(self.kind), np.int64)
        self.local[self.members] = np.arange(len(self.members)) - self.bounds[kinds]
        mass = np.bincount(kinds, self.weight[self.members], params.rest)
        share = self.weight[self.members] / mass[kinds]
        self.bias = np.zeros(len(self.kind), np.float32)
        self.bias[self.members] = np.log(share)
        # class number plus the members' shares added up: a draw within a class is one search
        whole = np.cumsum(share)
        self.upto = kinds + whole - np.concatenate([[0.0], whole])[self.bounds[kinds]]
        rng = np.random.default_rng(params.seed + 2)
        dim = params.word_dim
        self.target = np.zeros((len(self.kind), dim), np.float32)
        self.context = rng.normal(0, 0.3, (len(self.kind) + 1, dim)).astype(np.float32)
        self.position = np.ones((2, dim), np.float32)

    @property
    def begin(self) -> int:
        return len(self.kind)

    def tokens(self, number: np.ndarray, found_class: np.ndarray) -> np.ndarray:
        """Targets of the words of a text."""
        return np.where(number >= 0, number, self.words + found_class - self.params.own)

    def examples(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(before last, last, target, text) of all words that are no class of their own."""
        flat, at = after_two(tokens, sizes, self.begin)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        taken = self.kind[tokens] >= 0
        at, owner = at[taken], owner[taken]
        return flat[at - 2], flat[at - 1], flat[at], owner

    def predicted(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.context[first] * self.position[0] + self.context[last] * self.position[1]

    def log10(self, first: np.ndarray, last: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of targets within their classes; equal contexts are normalised once."""
        mine = np.einsum("bd,bd->b", self.target[target], self.predicted(first, last)) + self.bias[target]
        whole = np.zeros(len(target))
        order = np.argsort(self.kind[target].astype(np.int16), kind="stable")
        ends = np.searchsorted(self.kind[target][order], np.arange(self.params.rest + 1))
        for e in range(self.params.rest):
            own = self.members[self.bounds[e] : self.bounds[e + 1]]
            vectors, bias = self.target[own].T, self.bias[own]
            at = order[ends[e] : ends[e + 1]]
            context, place = np.unique(first[at] * (self.begin + 1) + last[at], return_inverse=True)
            total = np.zeros(len(context))
            # so many that their scores stay in the processor's cache
            size = max(64, (1 << 16) // max(1, len(own)))
            for k in range(0, len(context), size):
                before, after = np.divmod(context[k : k + size], self.begin + 1)
                scores = self.predicted(before, after) @ vectors
                scores += bias
                top = scores.max(1)
                scores -= top[:, None]
                total[k : k + size] = top + np.log(np.exp(scores, out=scores).sum(1))
            whole[at] = total[place]
        return (mine - whole) / math.log(10)

    def learn(self, first: np.ndarray, last: np.ndarray, target: np.ndarray, squares: list[np.ndarray], rng: np.random.Generator) -> None:
        """One step of NCE; Adagrad on what was met.

        Each target meets words drawn from its own class by frequency; the targets of one class in a step
        share their draws, so that all products are those of three matrices.
        """
        k, rest = self.params.word_noise, self.params.rest
        drawn = np.arange(rest)[:, None] + rng.random((rest, k))
        found = np.minimum(np.searchsorted(self.upto, drawn, "right"), self.bounds[1:, None] - 1)
        noise = self.members[found].ravel()
        # targets of one class stand together, and meet the words drawn from it only
        kind = self.kind[target].astype(np.int16)
        order = np.argsort(kind, kind="stable")
        first, last, target = first[order], last[order], target[order]
        ends = np.searchsorted(kind[order], np.arange(rest + 1)).tolist()
        classes = [(e, slice(a, b)) for e, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
        r1, r2 = self.context[first], self.context[last]
        q = r1 * self.position[0] + r2 * self.position[1]
        vectors, others = self.target[target], self.target[noise].reshape(rest, k, -1)
        # frequencies are the noise and the bias, so they cancel
        shift = np.float32(math.log(k))
        good = sigmoid(np.einsum("bd,bd->b", vectors, q) - shift) - 1
        bad = np.zeros((len(target), k), np.float32)
        for e, of in classes:
            np.matmul(q[of], others[e].T, out=bad[of])
        bad = sigmoid(bad - shift)
        back, met = good[:, None] * vectors, np.zeros_like(others)
        for e, of in classes:
            back[of] += bad[of] @ others[e]
            np.matmul(bad[of].T, q[of], out=met[e])
        steps = (
            (self.target, np.concatenate([target, noise]), np.concatenate([good[:, None] * q, met.reshape(len(noise), -1)]), squares[0]),
            (self.context, np.concatenate([first, last]), np.concatenate([back * self.position[0], back * self.position[1]]), squares[1]),
        )
        position = np.stack([(back * r1).sum(0), (back * r2).sum(0)])
        for values, met, gradient, square in steps:
            # numbers that fit are sorted digit by digit
            met = met.astype(np.int16) if len(values) < 1 << 15 else met
            order = np.argsort(met, kind="stable")
            met = met[order]
            fresh = np.ones(len(met), bool)
            np.not_equal(met[1:], met[:-1], out=fresh[1:])
            start = np.flatnonzero(fresh)
            self._step(values, met[start], np.add.reduceat(gradient[order], start), square)
        self._step(self.position, np.arange(2), position, squares[2])

    def _step(self, values: np.ndarray, met: np.ndarray, gradient: np.ndarray, square: np.ndarray) -> None:
        total = square[met] + gradient * gradient
        square[met] = total
        gradient *= np.float32(self.params.word_rate)
        gradient /= np.sqrt(total, out=total)
        values[met] -= gradient

    def parts(self) -> list[np.ndarray]:
        return [self.target, self.context, self.position]


def trained_words(texts: DataFrame, known: list[bytes], words: WordModel, params: Params) -> WordModel:
    """The word vectors after one pass over the texts, averaged over the tasks that read them."""
    return learnt(texts, known, words, params)[2]


def learnt(texts: DataFrame, known: list[bytes], words: WordModel, params: Params) -> tuple[np.ndarray, np.ndarray, WordModel]:
    """Codes of the class triples of all texts, their counts, and the trained word vectors, in one pass."""
    shared = texts.sparkSession.sparkContext.broadcast((known, words))
    chunk, lesson = 4096, params.lesson
    schema = pa.schema([("at", pa.int64()), ("n", pa.float64()), ("part", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = shared.value
        words = copy.deepcopy(words)
        classes, rng = Classes(known, params), np.random.default_rng(params.seed + 3)
        squares = [np.full_like(x, 0.1) for x in words.parts()]
        total, seen = np.zeros(params.classes**3, np.int64), 0
        for batch in batches:
            learns, upto = batch.column("learns").to_numpy(zero_copy_only=False), 0
            for found, sizes in pieces_of(batch.column("text"), lesson):
                number, found_class = classes.of(found)
                np.add.at(total, triples(found_class, sizes, params)[0], 1)
                taken = learns[upto : upto + len(sizes)]
                upto += len(sizes)
                tokens = words.tokens(number, found_class)[np.repeat(taken, sizes)]
                first, before, target, _ = words.examples(tokens, sizes[taken])
                order = rng.permutation(len(target))
                for k in range(0, len(order), params.word_batch):
                    at = order[k : k + params.word_batch]
                    words.learn(first[at], before[at], target[at], squares, rng)
                seen += len(target)
        # counts have places below 0
        code = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(-1 - code), pa.array(total[code].astype(np.float64)), pa.nulls(len(code), schema.field("part").type)], schema=schema
        )
        if seen:
            flat = np.concatenate([x.ravel() for x in words.parts()]).astype(np.float64) * seen
            for k in range(0, len(flat), chunk):
                yield rows(schema, at=[k], n=[float(seen)], part=[flat[k : k + chunk]])

    def add(key, table):
        total = np.sum(np.stack(table["part"].to_numpy()), axis=0) / table["n"].sum()
        return table.iloc[:1][["at"]].assign(part=[total])

    learns = F.pmod(F.xxhash64(F.lit(params.seed), "text"), F.lit(1 << 20)) < int(params.learn * (1 << 20))
    found = stored(texts.select("text", learns.alias("learns")).mapInArrow(run, "at long, n double, part array<double>"), "lm-learnt")
    counted = found.where("at < 0").groupBy((-1 - F.col("at")).alias("code")).agg(F.sum("n").alias("n")).toPandas()
    flat = np.concatenate([x.ravel() for x in words.parts()])
    for r in found.where("at >= 0").groupBy("at").applyInPandas(add, "at long, part array<double>").collect():
        flat[r.at : r.at + len(r.part)] = r.part
    words = copy.deepcopy(words)
    for x in words.parts():
        x[:], flat = flat[: x.size].reshape(x.shape), flat[x.size :]
    return counted["code"].to_numpy(np.int64), counted["n"].to_numpy(np.float64), words


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class LogBilinear:
    """Predicted vector of a context: the position-weighted sum of its classes' vectors;
    a class's score: its target vector's product with that, plus a bias."""

    def __init__(self, params: Params, frequency: np.ndarray):
        rng = np.random.default_rng(params.seed)
        size, dim = params.classes, params.dim
        self.context = rng.normal(0, 0.1, (size, dim)).astype(np.float32)
        self.position = np.ones((2, dim), np.float32)
        self.target = rng.normal(0, 0.1, (size, dim)).astype(np.float32)
        self.bias = np.log(frequency).astype(np.float32)

    def train(self, codes: np.ndarray, counts: np.ndarray, frequency: np.ndarray, params: Params) -> None:
        """NCE: tell a token drawn from the triples from ``noise`` ones drawn by frequency, by Adagrad."""
        rng = np.random.default_rng(params.seed + 1)
        size, k = params.classes, params.noise
        chance = np.cumsum(counts) / counts.sum()
        log_noise = np.log(k * frequency).astype(np.float32)
        parts = (self.context, self.position, self.target, self.bias)
        squares = [np.full_like(p, 1e-6) for p in parts]
        one_hot = np.eye(size, dtype=np.float32)
        for step in range(params.steps):
            code = codes[np.minimum(np.searchsorted(chance, rng.random(params.batch)), len(codes) - 1)]
            first, second, word = code // (size * size), code // size % size, code % size
            noise = rng.choice(size, k, p=frequency)
            r1, r2 = self.context[first], self.context[second]
            q = r1 * self.position[0] + r2 * self.position[1]
            good = sigmoid((q * self.target[word]).sum(1) + self.bias[word] - log_noise[word]) - 1
            bad = sigmoid(q @ self.target[noise].T + self.bias[noise] - log_noise[noise])
            dq = good[:, None] * self.target[word] + bad @ self.target[noise]
            hot_word, hot_noise = one_hot[word], one_hot[noise]
            d_target = hot_word.T @ (good[:, None] * q) + hot_noise.T @ (bad.T @ q)
            d_bias = hot_word.T @ good + hot_noise.T @ bad.sum(0)
            d_context = one_hot[first].T @ (dq * self.position[0]) + one_hot[second].T @ (dq * self.position[1])
            d_position = np.stack([(dq * r1).sum(0), (dq * r2).sum(0)])
            rate = params.rate * (1 - step / params.steps)
            for p, g, s in zip(parts, (d_context, d_position, d_target, d_bias), squares):
                g /= params.batch
                s += g * g
                p -= rate * g / np.sqrt(s)

    def log10_table(self, params: Params) -> np.ndarray:
        """Normalised log10 probabilities of every class after every pair of classes."""
        q = (self.context * self.position[0])[:, None, :] + (self.context * self.position[1])[None, :, :]
        scores = q.reshape(-1, params.dim) @ self.target.T + self.bias
        scores[:, params.begin] = -np.inf
        top = scores.max(1, keepdims=True)
        scores -= top + np.log(np.exp(scores - top).sum(1, keepdims=True))
        return (scores / math.log(10)).astype(np.float32).ravel()


@dataclass(frozen=True)
class Model:
    """What a scoring task needs; every part is bounded by ``Params``."""

    params: Params
    top: list[bytes]
    hot: dict[bytes, float]
    words: WordModel
    table: np.ndarray
    train_tokens: int
    distinct: int
    texts: int


def train(texts: DataFrame, params: Params) -> tuple[Model, DataFrame]:
    """The model of the training texts, and their stored word counts."""
    counts = stored(word_counts(texts, params), "lm-words")
    n_texts = texts.count()
    whole = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens = (whole.n or 0) + n_texts
    common = counts.where(F.col("n") >= max(1.0, params.hot_share * train_tokens))
    hot = {bytes(r.word): float(r.n) for r in common.orderBy(F.desc("n"), "word").limit(int(1 / params.hot_share) + 1).collect()}
    top = list(hot)[: params.own]
    ending = F.crc32(F.col("word").substr(F.greatest(F.lit(1), F.octet_length("word") - 1), F.lit(2))) % params.rest
    own = [w.decode("utf-8") for w in top]
    others = counts.where(~F.col("word").cast("string").isin(own)) if own else counts
    mass = np.full(params.classes, SMOOTH)
    for r in others.groupBy(ending.cast("int").alias("e")).agg(F.sum(F.col("n") + SMOOTH).alias("m")).collect():
        mass[params.own + r.e] += r.m
    classes = Classes(list(hot), params).own[:-1]
    smoothed = np.array(list(hot.values())) + SMOOTH
    held = np.bincount(classes, smoothed, params.classes) if len(classes) else np.zeros(params.classes)
    rest_mass = np.maximum(mass - held, SMOOTH)[params.own : params.own + params.rest]
    codes, n, words = learnt(texts, list(hot), WordModel(classes, smoothed, rest_mass, params), params)
    frequency = np.bincount(codes % params.classes, weights=n, minlength=params.classes) + 1e-3
    frequency /= frequency.sum()
    model = LogBilinear(params, frequency)
    if len(codes):
        model.train(codes, n, frequency, params)
    table = model.log10_table(params)
    return Model(params, top, hot, words, table, train_tokens, whole.v + (n_texts > 0), n_texts), counts


def score_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 10, held_out: int = 0, params: Params | None = None
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learns from texts whose crc32(id) modulo ``parts`` is not ``held_out``; a null id
    counts as empty text. ``base_score`` is the sum of log10 ((c + 0.1) / (N + 0.1 (V + 1)))
    over a text's tokens, ``score`` the model's log10 probability of the text. A null
    text is an empty one, which has its end only. Repeated rows count and are scored each.
    Without training texts the base score is 0 and the model is uniform in its classes.
    Whole texts of any length are scored. Of equally common words the smaller in bytes
    comes first. Other columns are left out; an empty table gives an empty result.
    """
    params = params or Params()
    taken = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), (fold(doc_id, parts) == held_out).alias("held_out")
    )
    model, counts = train(taken.where(~F.col("held_out")).select("text"), params)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = taken.schema["id"].dataType.simpleString()
    numbers = {"row": pa.int64(), "tokens": pa.int64(), "known": pa.int64(), "base": pa.float64(), "lm": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        p = m.params
        classes = Classes(list(m.hot), p)
        log_hot = np.log10(np.array(list(m.hot.values()) + [1.0]) + SMOOTH)
        log_hot[-1] = 0
        log_rest = np.log10(m.words.weight[m.words.words :])
        total = math.log10(m.train_tokens + SMOOTH * (m.distinct + 1))
        end = math.log10(m.texts + SMOOTH) - total

        def put_out(word: pa.Array, docs: pa.Array, ids: pa.Array, **values) -> pa.RecordBatch:
            filled = [pa.array(values[n], t) if n in values else pa.nulls(len(word), t) for n, t in numbers.items()]
            return pa.RecordBatch.from_arrays([word, docs, ids, *filled], names=["word", "docs", "id", *numbers])

        def listed(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int64()))

        for batch in batches:
            rows_of, ids, upto = batch.column("row").to_numpy(), batch.column("id"), 0
            for found, sizes in pieces_of(batch.column("text"), p.piece):
                n, row = len(sizes), rows_of[upto : upto + len(sizes)]
                number, found_class = classes.of(found)
                owner = np.repeat(np.arange(n), sizes)
                # words without a number, each with the rows of its texts
                unknown = np.flatnonzero(number < 0)
                coded = found.take(pa.array(unknown)).dictionary_encode()
                code = coded.indices.to_numpy()
                met = row[owner[unknown[np.argsort(code, kind="stable")]]]
                words = coded.dictionary
                yield put_out(words, listed(met, np.bincount(code, minlength=len(words))), pa.nulls(len(words), ids.type))
                base = np.bincount(owner, weights=log_hot[number], minlength=n) - total * sizes + end
                triple, of = triples(found_class, sizes, p)
                lm = np.bincount(of, weights=m.table[triple], minlength=n)
                first, last, target, of = m.words.examples(m.words.tokens(number, found_class), sizes)
                lm += np.bincount(of, weights=m.words.log10(first, last, target), minlength=n)
                # of a word without a number: the logarithm of its count, met in the join, less that of all such words
                unmet = np.flatnonzero(target >= m.words.words)
                lm -= np.bincount(of[unmet], weights=log_rest[target[unmet] - m.words.words], minlength=n)
                # keys with a blank are no words, so these rows find no count and are spread evenly
                keys = pa.array([b" %d" % r for r in row.tolist()], pa.binary())
                known = sizes - np.bincount(owner[unknown], minlength=n) + (m.texts > 0)
                yield put_out(keys, listed(row, np.ones(n, np.int64)), ids.slice(upto, n), row=row, tokens=sizes + 1, known=known, base=base, lm=lm)
                upto += n

    parts_of = taken.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
        run, f"word binary, docs array<long>, id {kind}, row long, tokens long, known long, base double, lm double"
    )
    log_count = F.when(F.col("row").isNull(), F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTH))
    met = parts_of.join(counts, "word", "left").select(
        F.explode("docs").alias("at"), "id", "tokens",
        (F.coalesce("known", F.lit(0)) + F.when(F.col("n").isNotNull(), 1).otherwise(0)).alias("known"),
        (F.coalesce("base", F.lit(0.0)) + F.coalesce(log_count, F.lit(0.0))).alias("base"),
        (F.coalesce("lm", F.lit(0.0)) + F.coalesce(log_count, F.lit(0.0))).alias("lm"),
    )
    summed = met.groupBy("at").agg(
        F.max("id").alias(doc_id), F.max("tokens").alias("n_tokens"), F.sum("known").cast("long").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("lm").alias("score"),
    )
    return summed.select(
        doc_id, (fold(doc_id, parts) == held_out).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
