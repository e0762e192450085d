"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

A text's statistics are counts of byte classes, words, lines and repetitions, and the
strongest block of 32 words of some of them, computed for many texts at once from their
UTF-8. Statistics become at most ``bins`` bins each; a level of a tree is chosen from
histograms of gradients by node, statistic and bin. The trees are complete and lie flat in
arrays, so that a batch of texts descends all trees together, one array step a level.
Labels come from a bounded sample; scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import fold, mix64, stretches


@dataclass(frozen=True)
class Params:
    """``fit_docs``: labelled texts that training takes at most, drawn by a hash of the id.
    ``section_bytes``: longer texts are measured in sections, whose counts add up and of
    whose block shares the highest counts. The rest is the trees' size and training."""

    fit_docs: int = 12_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.2
    penalty: float = 1.0
    least: float = 2.0
    block_words: int = 32
    section_bytes: int = 1 << 16
    batch_bytes: int = 1 << 21
    seed: int = 11


CLASSES = ("space", "break", "upper", "lower", "digit", "stop", "shout", "symbol", "quote", "lead", "tail", "other")


def _classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.uint8)
    members = {
        "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "lead": range(192, 256), "tail": range(128, 192),
        "space": b" \t\r\x0b\x0c", "break": b"\n", "stop": b".,;:", "shout": b"!?", "symbol": b"#*$%&|<>@~^_=+/\\{}[]", "quote": b"\"'()-`",
    }
    for name, values in members.items():
        table[list(values)] = CLASSES.index(name)
    return table


_CLASS = _classes()
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_END = np.isin(np.arange(256), list(b".!?"))
_FACTORS = mix64(np.arange(1, 65)) | np.uint64(1)

WORD_FLAGS = ("caps", "marked", "letterless", "again")
SUMS = (*CLASSES, "words", *WORD_FLAGS, "distinct", "pairs", "distinct_pairs", "long", "squares", "lines", "distinct_lines", "ended")
TOPS = (*(f"most_{f}" for f in WORD_FLAGS), "longest_word", "longest_line")
NAMES = (
    "log_chars", "log_words", "log_lines", *(f"share_{c}" for c in CLASSES), *(f"words_{f}" for f in WORD_FLAGS), "words_distinct",
    "pairs_distinct", "words_long", "word_mean", "word_spread", "lines_distinct", "lines_ended", "line_words", *TOPS,
)


def sections(text: bytes, size: int) -> list[bytes]:
    """The text in runs of whole words of about ``size`` bytes; a longer word is cut."""
    out, start = [], 0
    while len(text) - start > size:
        at = max(text.rfind(b" ", start + 1, start + size), text.rfind(b"\n", start + 1, start + size))
        stop = at if at > 0 else start + size
        out.append(text[start:stop])
        start = stop
    return [*out, text[start:]]


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each owner has."""
    _, first = np.unique(mix64(keys) + mix64(owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    return np.bincount(owner[first], minlength=n)


def counts(parts: list[bytes], block: int) -> tuple[np.ndarray, np.ndarray]:
    """``SUMS`` and ``TOPS`` of each section."""
    n = len(parts)
    raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    sizes = np.array([len(x) + 1 for x in parts])
    owner = np.repeat(np.arange(n), sizes)
    kinds = _CLASS[raw]
    found = {c: x for c, x in zip(CLASSES, np.bincount(owner * len(CLASSES) + kinds, minlength=n * len(CLASSES)).reshape(n, -1).T)}
    found["break"] = found["break"] - 1
    space = _SPACE[raw]
    before = np.concatenate([[True], space[:-1]])
    start, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    length, own = stop - start, owner[start]

    def within(*names: str) -> np.ndarray:
        """In each word, the bytes of these classes."""
        upto = np.concatenate([[0], np.cumsum(np.isin(kinds, [CLASSES.index(c) for c in names]), dtype=np.int64)])
        return upto[stop] - upto[start]

    upper, lower, symbols = within("upper"), within("lower"), within("symbol", "shout")
    inside = np.flatnonzero(~space)
    place = inside - np.repeat(start, length)
    bounds = np.cumsum(length) - length
    value = (raw[inside].astype(np.uint64) + np.uint64(1)) * _FACTORS[place & 63]
    key = mix64(np.add.reduceat(value, bounds) if len(bounds) else np.zeros(0, np.uint64)) + length.astype(np.uint64)
    near = own[1:] == own[:-1]
    again = np.concatenate([[False], near & (key[1:] == key[:-1])])[: len(own)]
    flags = {"caps": (upper >= 2) & (lower == 0), "marked": symbols > 0, "letterless": upper + lower + within("lead") == 0, "again": again}
    sums = lambda values: np.bincount(own, weights=values, minlength=n)
    words = np.bincount(own, minlength=n)
    found |= {"words": words, **{f: sums(v) for f, v in flags.items()}}
    found["distinct"] = _distinct(key, own, n)
    pair = np.flatnonzero(near)
    found["pairs"] = np.bincount(own[pair], minlength=n)
    found["distinct_pairs"] = _distinct(mix64(key[pair]) + key[pair + 1], own[pair], n)
    found["long"], found["squares"] = sums(length > 20), sums(length.astype(float) ** 2)

    # lines with a word: their words in order make their key
    line = np.cumsum(raw == 10)[start] if len(start) else np.zeros(0, np.int64)
    opens = np.flatnonzero(np.diff(line, prepend=-1))
    held = np.diff(np.append(opens, len(line)))
    at = np.arange(len(line)) - np.repeat(opens, held)
    whole = np.add.reduceat(mix64(key + at.astype(np.uint64)), opens) if len(opens) else np.zeros(0, np.uint64)
    line_own = own[opens]
    found["lines"] = np.bincount(line_own, minlength=n)
    found["distinct_lines"] = _distinct(whole, line_own, n)
    found["ended"] = np.bincount(line_own, weights=_END[raw[stop[opens + held - 1] - 1]], minlength=n)

    def highest(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(n)
        np.maximum.at(out, owner, values)
        return out

    first = np.cumsum(words) - words
    fresh = (np.arange(len(own)) - first[own]) % block == 0
    blocks = np.cumsum(fresh) - 1
    block_own, size = own[fresh], np.maximum(np.bincount(blocks), block // 2) if len(own) else np.zeros(0)
    tops = [highest(block_own, np.bincount(blocks, weights=v, minlength=len(size))[: len(size)] / size) for v in flags.values()]
    tops += [highest(own, length), highest(line_own, held)]
    return np.stack([found[c] for c in SUMS], 1).astype(float), np.stack(tops, 1)


def statistics(texts: list[bytes], p: Params) -> np.ndarray:
    """``NAMES`` of each text, a row each; shares of nothing are 0."""
    parts = [sections(t, p.section_bytes) for t in texts]
    first = np.cumsum([0, *(len(x) for x in parts)])[:-1]
    sums, tops = counts([s for x in parts for s in x], p.block_words)
    total, most = np.add.reduceat(sums, first), np.maximum.reduceat(tops, first)
    v = dict(zip(SUMS, total.T))
    size = sum(v[c] for c in CLASSES)
    chars = size - v["tail"]
    share = lambda a, b: np.divide(a, b, out=np.zeros(len(texts)), where=b > 0)
    mean = share(size - v["space"] - v["break"], v["words"])
    rows = [np.log1p(chars), np.log1p(v["words"]), np.log1p(v["lines"]), *(share(v[c], size) for c in CLASSES)]
    rows += [share(v[f], v["words"]) for f in (*WORD_FLAGS, "distinct")] + [share(v["distinct_pairs"], v["pairs"])]
    rows += [share(v["long"], v["words"]), mean, np.sqrt(np.maximum(share(v["squares"], v["words"]) - mean**2, 0))]
    rows += [share(v["distinct_lines"], v["lines"]), share(v["ended"], v["lines"]), share(v["words"], v["lines"])]
    return np.concatenate([np.stack(rows, 1), most], 1).astype(np.float32)


@dataclass(frozen=True)
class Trees:
    """Complete trees in arrays (tree, node); the children of node i are 2 i + 1 and 2 i + 2.

    A row goes to the second child where its statistic exceeds the node's limit. Nodes that
    need no division have no limit, and ``value`` holds the leaves of the last level.
    """

    base: float
    depth: int
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row, all trees descended at once."""
        out = np.full(len(x), self.base)
        tree = np.arange(len(self.feature))[None, :]
        inner = self.feature.shape[1]
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (part[row, self.feature[tree, node]] > self.limit[tree, node])
            out[a : a + 4096] += self.value[tree, node - inner].sum(1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -50, 50)))


def bin_limits(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Of each statistic, at most ``bins - 1`` limits halfway between neighbouring values, alike in count."""
    out = []
    for column in x.T:
        values, n = np.unique(column, return_counts=True)
        middle = ((values[1:].astype(np.float64) + values[:-1]) / 2).astype(np.float32)
        part = (np.cumsum(n)[:-1] * bins) // max(1, len(x))
        keep = np.flatnonzero(np.diff(part, append=bins)) if len(values) > bins else np.arange(len(middle))
        out.append(middle[keep][: bins - 1])
    return out


def fit(x: np.ndarray, labels: np.ndarray, p: Params) -> Trees:
    """Trees by second-order boosting of the logistic loss. Equal gains take the earlier statistic and limit."""
    inner, leaves = 2**p.depth - 1, 2**p.depth
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        # one kind of label only, or none: every text scores that
        certain = 0.0 if not len(labels) else (20.0 if share else -20.0)
        return Trees(certain, p.depth, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)))
    base = float(np.log(share / (1 - share)))
    cuts = bin_limits(x, p.bins)
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], 1)
    allowed = np.array([[b < len(c) for b in range(p.bins)] for c in cuts])
    margin = np.full(len(x), base)
    trees = []
    for _ in range(p.trees):
        score = 1 / (1 + np.exp(-margin))
        pull, weight = score - labels, np.maximum(score * (1 - score), 1e-12)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(x), np.int64)
        for level in range(p.depth):
            size = 2**level
            here = node - (size - 1)
            g, h = (_histogram(here, binned, w, size, p.bins).cumsum(2) for w in (pull, weight))
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            right_g, right_h = all_g - g, all_h - h
            gain = g**2 / (h + p.penalty) + right_g**2 / (right_h + p.penalty) - all_g**2 / (all_h + p.penalty)
            gain = np.where(allowed[None] & (h >= p.least) & (right_h >= p.least), gain, 0).reshape(size, -1)
            best = gain.argmax(1)
            for k in np.flatnonzero(gain[np.arange(size), best] > 1e-9):
                f, b = divmod(int(best[k]), p.bins)
                feature[size - 1 + k], limit[size - 1 + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
        leaf = node - inner
        value = -p.rate * np.bincount(leaf, pull, leaves) / (np.bincount(leaf, weight, leaves) + p.penalty)
        margin += value[leaf]
        trees.append((feature, limit, value))
    return Trees(base, p.depth, *(np.stack(part) for part in zip(*trees)))


def _histogram(node: np.ndarray, binned: np.ndarray, weight: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """Sums of weights by node, statistic and bin."""
    return np.stack([np.bincount(node * bins + b, weight, nodes * bins).reshape(nodes, bins) for b in binned.T], 1)


def measured(docs: DataFrame, p: Params, also: list[str] = ()) -> DataFrame:
    """Statistics of each row as bytes of single floats, with ``id`` and the columns ``also``."""
    names = ["id", *also]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in stretches(batch.column("text"), p.batch_bytes):
                part = batch.slice(a, b - a)
                found = [x.tobytes() for x in statistics(part.column("text").to_pylist(), p)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(found, pa.binary())], names=[*names, "x"])

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in names]
    return docs.select(*names, "text").mapInArrow(run, ", ".join([*kinds, "x binary"]))


def sample(docs: DataFrame, labels: DataFrame, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``fit_docs`` labelled texts.

    Of rows that share an id the smallest statistics stand for all, so that the sample does
    not depend on the order of rows.
    """
    per_doc = labels.groupBy("id").agg(F.min("good").alias("good"))
    draw = F.pmod(F.xxhash64(F.lit(p.seed), "id"), F.lit(1 << 40))
    share = min(1.0, 1.25 * p.fit_docs / max(1, per_doc.count()))
    # at most about 1.25 fit_docs rows, whatever the table's size
    chosen = F.broadcast(per_doc.where(draw < int(share * (1 << 40))))
    found = measured(docs.join(chosen, "id").select("id", "text", "good"), p, ["good"])
    rows = found.groupBy("id").agg(F.min("x").alias("x"), F.min("good").alias("good"), F.min(draw).alias("draw")).collect()
    rows = sorted(rows, key=lambda r: (r["draw"], r["id"]))[: p.fit_docs]
    x = np.frombuffer(b"".join(r["x"] for r in rows), np.float32).reshape(len(rows), len(NAMES))
    return x, np.array([r["good"] for r in rows], np.int64)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label_id: str = "doc_id",
    label: str = "quality",
    parts: int = 3,
    held_out: int = 1,
    params: Params | None = None,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` (higher: rather good), ``predicted``.

    Learns from labels of ids whose crc32 modulo ``parts`` is not ``held_out`` (a null id
    counts as empty text, and matches no label); null labels are left out, and a document
    labelled twice is good if all its labels say so. A null text counts as empty, and an
    empty one is scored like any other. Equal texts score alike, so repeated rows do. Whole
    texts are measured, of any length. With labels of one kind every score is next to that
    label, without labels 0.5. Other columns are left out; an empty table gives an empty
    result.
    """
    p = params or Params()
    taken = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    known = labels.select(F.col(label_id).alias("id"), (F.col(label) > 0).cast("int").alias("good"))
    known = known.where((fold("id", parts) != held_out) & F.col("id").isNotNull() & F.col("good").isNotNull())
    shared = docs.sparkSession.sparkContext.broadcast(fit(*sample(taken, known, p), p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            for a, b in stretches(batch.column("text"), p.batch_bytes):
                part = batch.slice(a, b - a)
                scores = trees.scores(statistics(part.column("text").to_pylist(), p))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    kind = taken.schema["id"].dataType.simpleString()
    scored = taken.mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(doc_id), (fold("id", parts) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
