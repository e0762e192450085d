"""Benchmark decontamination by latent semantic retrieval.

The terms are the words of the benchmark, weighted by how rare they are in the passages of
all documents. Every text is split once; its words' term numbers are stored beside it, and all
that follows reads those. A randomised singular value decomposition of the TF-IDF passages of
all documents gives a latent space: tasks add up the products of the terms that stand in a
passage together, these sums lie in a table, and its product with random vectors, ``terms x
rank`` numbers, is what is gathered. Every passage of every document, overlapping
windows of two widths, is then compared with all benchmark pieces by cosine. For candidates
the longest common subsequence of words decides; where it is only fairly long, as in a
paraphrase, the item's answer, its last words, must be there too. Besides, every run of
``run`` words of every item is looked up exactly, so that a verbatim excerpt counts
wherever in the item it stands.

The benchmark is a stated set: it is taken in blocks of ``block_items`` items, and each block
is compared with all documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.llm.common import cut_words, mix64, numbers_in, rows, stored, stretches

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Params:
    """``step``: words between passages; ``widths``: a passage's length in steps. ``piece``:
    words of an item that are looked for together; a piece starts every ``stride`` words.
    ``run``: words in a row that make a verbatim excerpt. ``fit_docs``: as many documents
    as all documents together weigh at most in the decomposition beside the benchmark's own
    pieces; all of them are fitted, counted and searched. ``scans``: parts of the scan that one
    task adds products up over, where there are more than cores. ``cosine`` and ``held`` (the part of a piece's vector
    that a passage has) make a candidate; ``strong``, ``fair``, ``answer``: shares of words
    in order that make a copy, a paraphrase, and an answer found."""

    block_items: int = 200
    step: int = 16
    widths: tuple[int, ...] = (2, 4)
    piece: int = 48
    stride: int = 12
    run: int = 13
    rank: int = 256
    oversample: int = 8
    fit_docs: int = 2000
    fit_tasks: int = 12
    scans: int = 8
    held_bytes: int = 256_000_000
    cosine: float = 0.4
    held: float = 0.5
    strong: float = 0.8
    fair: float = 0.6
    answer: float = 0.8
    answer_words: int = 8
    chunk_words: int = 200_000
    seed: int = 3


def split_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


#: ASCII characters as words have them, blanks for those that no word has; other bytes as they are.
_ASCII_WORDS = bytes((ord(chr(b).lower()) if _WORD.match(chr(b)) else 32) if b < 128 else b for b in range(256))

_ASCII = bytes(range(128))


def plain_texts(texts: pa.Array) -> pa.Array:
    """The texts with characters beyond ASCII in lower case, and blanks for those that no word has.

    Characters are replaced by as many bytes, all texts at once. Where lower-casing needs more or
    fewer, or looks at neighbours, the texts are made of their words one by one.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    low, high = (int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset + k]) for k in (0, len(texts)))
    held = texts.buffers()[2]
    data = memoryview(held)[low:high].tobytes() if held is not None else b""
    replaced = {}
    for c in set(data.translate(None, _ASCII).decode()):
        lower = c.lower()
        new = lower.encode() if _WORD.fullmatch(lower) else b" " * len(c.encode())
        if c == "Σ" or len(new) != len(c.encode()) or lower.lower() != lower or (len(lower) > 1 and not _WORD.fullmatch(lower)):
            return pa.array([" ".join(split_words(t)) for t in texts.to_pylist()], pa.string())
        if new != c.encode():
            replaced[c.encode()] = new
    if not replaced:
        return texts
    for old, new in replaced.items():
        data = data.replace(old, new)
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] - np.int32(low)
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def numbered_texts(texts: pa.Array, known: pa.Array) -> pa.Array:
    """The places of each text's words in ``known``, -1 for others, packed."""
    kind, out = _kind(len(known)), []
    for low, high in stretches(texts, 1 << 21):
        words, sizes = cut_words(plain_texts(texts.slice(low, high - low)), _ASCII_WORDS)
        packed = numbers_in(words, known).astype(kind)
        bounds = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes * packed.itemsize, out=bounds[1:])
        out.append(pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(packed)]))
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where in the text itself the words of ``split_words`` stand. Lower-casing may lengthen a text."""
    lowered = text.lower()
    spans = [m.span() for m in _WORD.finditer(lowered)]
    if len(lowered) == len(text):
        return spans
    origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    return [(int(origin[a]), int(origin[b - 1]) + 1) for a, b in spans]


@dataclass(frozen=True)
class Piece:
    item: int
    words: tuple[str, ...]
    answer: tuple[str, ...]


def pieces_of(items: list[tuple[int, str]], p: Params) -> list[Piece]:
    """Items in overlapping runs of at most ``piece`` words; each carries its item's answer, the last words."""
    out = []
    for item, text in items:
        words = split_words(text)
        if not words:
            continue
        starts = list(range(0, max(1, len(words) - p.piece + 1), p.stride))
        if starts[-1] + p.piece < len(words):
            starts.append(len(words) - p.piece)
        out += [Piece(item, tuple(words[s : s + p.piece]), tuple(words[-p.answer_words :])) for s in starts]
    return out


@dataclass
class Passages:
    """Term numbers of consecutive texts' words in blocks of ``step`` words; ``words`` has each text's, -1 for no term."""

    words: list[np.ndarray]
    term: np.ndarray
    block: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def of(texts: list[list[str]], terms: dict[str, int], step: int) -> Passages:
        return Passages.numbered([np.array([terms.get(w, -1) for w in ws], np.int64) for ws in texts], step)

    @staticmethod
    def numbered(found: list[np.ndarray], step: int) -> Passages:
        sizes = [-(-len(t) // step) for t in found]
        starts = np.cumsum([0, *sizes])
        block = [start + np.flatnonzero(t >= 0) // step for start, t in zip(starts, found)]
        doc = np.repeat(np.arange(len(found)), sizes)
        first, last = starts[:-1][doc], starts[1:][doc]
        block = np.concatenate(block) if block else np.zeros(0, np.int64)
        return Passages(found, np.concatenate([t[t >= 0] for t in found]) if found else np.zeros(0, np.int64), block, doc, first, last)

    def joined(self, vectors: np.ndarray, starts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        """For each width, sums over the passages of so many blocks from each start; other blocks are left out."""
        wanted = np.zeros(len(self.doc) + 1, np.int64)
        for width, at in starts.items():
            np.add.at(wanted, at, 1)
            np.add.at(wanted, np.minimum(at + width, self.last[at]), -1)
        wanted = np.cumsum(wanted[:-1]) > 0
        # empty blocks after each run of wanted ones, so that neighbours are added without a look at the bounds
        gap = max(starts) - 1
        fresh = wanted.copy()
        fresh[1:] &= ~wanted[:-1] | (self.doc[1:] != self.doc[:-1])
        place = np.cumsum(wanted) - 1 + gap * (np.cumsum(fresh) - 1)
        n = int(wanted.sum() + gap * fresh.sum())
        mine = wanted[self.block]
        single = _block_sums(self.term[mine], place[self.block[mine]], n + gap, vectors)
        out, total, added = {}, single[:n].copy(), 1
        for width, at in sorted(starts.items()):
            for low in range(0, n, 1024):
                part = total[low : low + 1024]
                for k in range(added, width):
                    part += single[low + k : low + k + len(part)]
            added = width
            out[width] = total[place[at]]
        return out

    def held(self, weights: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """Weight of all terms from the block before each passage to the block after it, within the text."""
        per_block = np.bincount(self.block, weights=weights[self.term], minlength=len(self.doc))
        upto = np.concatenate([[0.0], np.cumsum(per_block)])
        low, high = np.maximum(at - 1, self.first[at]), np.minimum(at + width + 1, self.last[at])
        return upto[high] - upto[low]

    def starts(self, width: int) -> np.ndarray:
        """Blocks at which a passage starts: those where it fits, and a short text's first."""
        at = np.arange(len(self.doc))
        return (at + width <= self.last) | (at == self.first)


def _block_sums(term: np.ndarray, block: np.ndarray, blocks: int, vectors: np.ndarray) -> np.ndarray:
    """Sums of the term vectors of each of ``blocks`` blocks; ``block`` does not fall.

    Blocks are ordered by how many terms they hold, so that the k-th terms of all
    blocks that have one are added to a leading run of rows at once, few enough to stay in
    the processor's cache.
    """
    counts = np.bincount(block, minlength=blocks)
    order = np.argsort(-counts, kind="stable")
    starts, counts = (np.cumsum(counts) - counts)[order], counts[order]
    out = np.zeros((blocks, vectors.shape[1]), vectors.dtype)
    for low in range(0, int(np.count_nonzero(counts)), 256):
        size, start = counts[low : low + 256], starts[low : low + 256]
        part = np.zeros((len(size), vectors.shape[1]), vectors.dtype)
        for k in range(int(size[0])):
            have = int(np.searchsorted(-size, -k, side="left"))
            part[:have] += vectors[term[start[:have] + k]]
        out[order[low : low + 256]] = part
    return out


def _kind(terms: int) -> str:
    """The bytes of a stored term number."""
    return "<i2" if terms < 1 << 15 else "<i4"


def numbers_of(column: Column, vocabulary: dict[str, int]) -> Column:
    """The numbers of a text's words in the vocabulary, -1 for others, packed; null is an empty text."""
    shared = SparkSession.active().sparkContext.broadcast([w.encode() for w in vocabulary])

    def number(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pa.array(shared.value, pa.binary())
        for texts in batches:
            yield numbered_texts(texts, known)

    number.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(number, "binary")(column)


def _grouped(packed: list[bytes], own: np.ndarray, p: Params) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Runs of texts of about ``chunk_words`` words: where one starts and its texts' terms, numbered as in ``own``."""
    kind, held, size, start = _kind(len(own) - 1), [], 0, 0
    for i, value in enumerate(packed):
        held.append(own[np.frombuffer(value, kind)])
        size += len(held[-1])
        if size >= p.chunk_words:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def term_counts(numbered: DataFrame, own: np.ndarray, terms: int, p: Params) -> tuple[np.ndarray, int, int]:
    """In how many passages of all documents each of a block's terms stands; passages; documents."""
    shared = numbered.sparkSession.sparkContext.broadcast(own)
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])
    width = p.widths[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passages, texts = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            texts += batch.num_rows
            for _, held in _grouped(batch.column("terms").to_pylist(), shared.value, p):
                # passages that do not overlap: whole runs of ``width`` blocks of each text
                found = Passages.numbered(held, p.step * width)
                pairs = np.unique(found.block * terms + found.term)
                total += np.bincount(pairs % terms, minlength=terms)
                passages += len(found.doc)
        at = np.flatnonzero(total)
        yield rows(schema, term=[*at.tolist(), -1, -2], n=[*total[at].tolist(), passages, texts])

    counted = numbered.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    total, passages, texts = np.zeros(terms, np.int64), 0, 0
    for r in counted:
        if r.term >= 0:
            total[r.term] = r.n
        elif r.term == -1:
            passages = r.n
        else:
            texts = r.n
    return total, passages, texts


def lengthened(found: Passages, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block, term and value of every entry of the blocks' TF-IDF rows, each row of length 1."""
    unique, tf = np.unique(found.block * len(idf) + found.term, return_counts=True)
    block, term = unique // len(idf), unique % len(idf)
    value = tf * idf[term]
    length = np.sqrt(np.bincount(block, weights=value**2, minlength=len(found.doc)))
    return block, term, value / length[block]


class Products:
    """Sums over passages of the products of two terms' values, for first terms from ``low`` to ``high``.

    The second term is not before the first. Terms are numbered by how common they are: the
    ``LEAD`` commonest are columns of a matrix, whose products with all terms are sums of rows.
    Only products of two rarer terms are added one by one.
    """

    def __init__(self, terms: int, low: int, high: int):
        self.low, self.high = low, min(high, terms)
        self.lead = 0 if low else min(LEAD, self.high)
        self.sums = np.zeros((self.high - low, terms - low))

    def add(self, block: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        """Entries in the order of block and term."""
        leading = term < self.lead
        rarer = ~leading
        if leading.any():
            # blocks are a run of passages, so the matrix holds few more rows than have terms
            common = np.zeros((int(block[-1]) + 1, self.lead), np.float32)
            common[block[leading], term[leading]] = value[leading]
            self.sums[: self.lead, : self.lead] += np.triu(common.T @ common)
            self._met(common, block[rarer], term[rarer], value[rarer])
        self._paired(block[rarer], term[rarer], value[rarer])

    def _met(self, common: np.ndarray, block: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        """Products of rarer terms with the leading ones."""
        order = np.argsort(term, kind="stable")
        term = term[order]
        for low in range(0, len(order), 1 << 14):
            part = order[low : low + (1 << 14)]
            start = np.flatnonzero(np.diff(term[low : low + (1 << 14)], prepend=-1))
            sums = np.add.reduceat(common[block[part]] * value[part, None].astype(np.float32), start)
            self.sums[: self.lead, term[low + start]] += sums.T

    def _paired(self, block: np.ndarray, term: np.ndarray, value: np.ndarray) -> None:
        flat, wide = self.sums.reshape(-1), self.sums.shape[1]
        at = np.flatnonzero((term >= self.low) & (term < self.high))
        for k in range(len(block)):
            at = at[: np.searchsorted(at, len(block) - k)]
            at = at[block[at + k] == block[at]]
            if not len(at):
                break
            np.add.at(flat, (term[at] - self.low) * wide + term[at + k] - self.low, value[at] * value[at + k])

    def strips(self) -> Iterator[tuple[int, pa.Array]]:
        """Rows of ``STRIP`` terms from their diagonal on, as one list, with their first term."""
        for k in range(0, len(self.sums), STRIP):
            part = self.sums[k : k + STRIP, k:]
            if part.any():
                yield self.low + k, pa.ListArray.from_arrays(pa.array([0, part.size], pa.int32()), pa.array(part.astype(np.float32).ravel()))


#: Terms whose sums of products travel together.
STRIP = 16

#: Commonest terms, about half of all entries.
LEAD = 96


def term_products(numbered: DataFrame, own: np.ndarray, idf: np.ndarray, p: Params) -> DataFrame:
    """(first, part): strips of the ``Products`` of the normalised TF-IDF passages of all documents, stored.

    A task holds sums of ``held_bytes``; for more terms the numbers are read several times. Sums
    weigh the same however little a task reads, so a task reads several parts of the scan, of
    which the numbers are a small column.
    """
    read = numbered.select("terms")
    read = read.coalesce(max(read.sparkSession.sparkContext.defaultParallelism, read.rdd.getNumPartitions() // p.scans))
    shared = numbered.sparkSession.sparkContext.broadcast((own, idf))
    schema = pa.schema([("first", pa.int64()), ("part", pa.list_(pa.float32()))])
    size = max(STRIP, p.held_bytes // (8 * len(idf)) // STRIP * STRIP)

    def of(low: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, idf = shared.value
            sums = Products(len(idf), low, low + size)
            for batch in batches:
                for _, held in _grouped(batch.column("terms").to_pylist(), own, p):
                    sums.add(*lengthened(Passages.numbered(held, p.step * p.widths[-1]), idf))
            for first, part in sums.strips():
                yield rows(schema, first=[first], part=part)

        return read.mapInArrow(run, "first long, part array<float>")

    def add(key, table):
        return table.iloc[:1][["first"]].assign(part=[np.sum(np.stack(table["part"].to_numpy()), axis=0, dtype=np.float64)])

    found = reduce(DataFrame.unionByName, [of(low) for low in range(0, len(idf), size)])
    return stored(found.groupBy("first").applyInPandas(add, "first long, part array<float>"), "contamination-products")


def latent_space(products: DataFrame, pieces: list[list[str]], terms: dict[str, int], idf: np.ndarray, share: float, p: Params) -> np.ndarray:
    """Leading right singular vectors (terms, rank) of the TF-IDF matrix of the passages of all documents and the pieces.

    ``products`` are sums over all documents' passages; they weigh by ``share``.
    """
    rank = min(p.rank + p.oversample, len(terms))
    chunk = 256
    context = products.sparkSession.sparkContext
    # few tasks multiply, so that few sums meet
    dealt = products.repartition(p.fit_tasks)
    block, term, value = lengthened(Passages.of(pieces, terms, max(map(len, pieces))), idf)
    bounds = np.searchsorted(block, np.arange(len(pieces)))

    def pieces_times(basis: np.ndarray) -> np.ndarray:
        along = np.add.reduceat(value[:, None] * basis[term], bounds)
        out = np.zeros_like(basis)
        np.add.at(out, term, value[:, None] * along[block])
        return out

    def summed(basis: np.ndarray) -> np.ndarray:
        shared = context.broadcast(basis)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            basis = shared.value
            total = np.zeros_like(basis)
            for batch in batches:
                for low, part in zip(batch.column("first").to_pylist(), batch.column("part")):
                    upper = part.values.to_numpy().astype(np.float64).reshape(-1, len(basis) - low)
                    total[low : low + len(upper)] += upper @ basis[low:]
                    # what lies below the diagonal equals what lies above it
                    np.fill_diagonal(upper, 0)
                    total[low:] += upper.T @ basis[low : low + len(upper)]
            schema = pa.schema([("at", pa.int64()), ("part", pa.list_(pa.float64()))])
            for k in range(0, len(total), chunk):
                if total[k : k + chunk].any():
                    yield rows(schema, at=[k], part=[total[k : k + chunk].ravel()])

        def add(key, table):
            return table.iloc[:1][["at"]].assign(part=[np.sum(np.stack(table["part"].to_numpy()), axis=0)])

        # the benchmark's pieces weigh as much as all documents, so its directions lead
        total = pieces_times(basis) * max(1.0, p.fit_docs / len(pieces))
        found = dealt.mapInArrow(run, "at long, part array<double>").groupBy("at").applyInPandas(add, "at long, part array<double>")
        for r in found.collect():
            part = np.array(r.part).reshape(-1, basis.shape[1])
            total[r.at : r.at + len(part)] += share * part
        return total

    rng = np.random.default_rng(p.seed)
    basis, _ = np.linalg.qr(summed(rng.normal(size=(len(terms), rank))))
    after = summed(basis)
    _, vectors = np.linalg.eigh((basis.T @ after + after.T @ basis) / 2)
    return basis @ vectors[:, ::-1][:, : p.rank]


@dataclass(frozen=True)
class Runs:
    """All runs of ``size`` words of the items: their hashes in order, and for each its item and place in ``words``."""

    size: int
    words: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(items: list[tuple[int, str]], terms: dict[str, int], size: int) -> Runs:
        texts = [(item, np.array([terms[w] for w in split_words(text)], np.int64)) for item, text in items]
        words = _apart([t for _, t in texts])
        item = np.repeat([i for i, _ in texts], [len(t) + 1 for _, t in texts]).astype(np.int64)
        at = _whole(words, size)
        hashes = _hashes(words, at, size)
        # of equal runs within an item, the first
        _, first = np.unique(np.stack([hashes.view(np.int64), item[at]]), axis=1, return_index=True)
        first = first[np.argsort(hashes[first], kind="stable")]
        return Runs(size, words, hashes[first], item[at[first]], at[first])

    def shared(self, texts: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first word, end word) of the stretches whose every run of words stands in the item."""
        words = _apart(texts)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        at = _whole(words, self.size)
        hashes = _hashes(words, at, self.size)
        low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
        open_: dict[int, tuple[int, int]] = {}
        for k in np.flatnonzero(high > low).tolist():
            here = int(at[k])
            for j in range(low[k], high[k]):
                if np.array_equal(self.words[self.at[j] : self.at[j] + self.size], words[here : here + self.size]):
                    item = int(self.item[j])
                    first, last = open_.get(item, (here, here))
                    if here > last + 1:
                        yield self._stretch(starts, item, first, last)
                        first = here
                    open_[item] = (first, here)
        for item, (first, last) in open_.items():
            yield self._stretch(starts, item, first, last)

    def _stretch(self, starts: np.ndarray, item: int, first: int, last: int) -> tuple[int, int, int, int]:
        text = int(np.searchsorted(starts, first, "right")) - 1
        return text, item, first - int(starts[text]), last - int(starts[text]) + self.size


def _apart(texts: list[np.ndarray]) -> np.ndarray:
    """The texts' term numbers one after another, with -1 after each text."""
    return np.concatenate([x for t in texts for x in (t, [-1])]).astype(np.int64) if texts else np.zeros(0, np.int64)


def _whole(words: np.ndarray, size: int) -> np.ndarray:
    """Where ``size`` terms follow each other without another word between."""
    ends = np.flatnonzero(words < 0)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    n = ends - first - size + 1
    first, n = first[n > 0], n[n > 0]
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _hashes(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mix64(words[at + k] + 1)
    return out


@dataclass(frozen=True)
class Space:
    """What a searching task needs; every part is bounded by a block of the benchmark."""

    params: Params
    terms: dict[str, int]
    vectors: np.ndarray
    pieces: list[Piece]
    targets: np.ndarray
    lengths: np.ndarray
    weight: dict[str, float]
    idf: np.ndarray
    runs: Runs
    own: np.ndarray

    @property
    def least(self) -> float:
        """The term weight that any hit needs, by ``enough`` with the lightest piece, less rounding."""
        lightest = min(sum(self.weight[w] for w in x.words) for x in self.pieces)
        return self.params.fair * lightest * (1 - 1e-6) - 1e-6


def fit(numbered: DataFrame, vocabulary: dict[str, int], items: list[tuple[int, str]], p: Params) -> Space | None:
    """The space of a block of items, fitted on all rows of ``numbered``, whose ``terms`` are numbers in the vocabulary."""
    found = pieces_of(items, p)
    if not found:
        return None
    terms = {w: i for i, w in enumerate(dict.fromkeys(w for x in found for w in x.words))}
    # the last entry, which -1 finds, is that of other words
    own = np.full(len(vocabulary) + 1, -1, np.int64)
    own[[vocabulary[w] for w in terms]] = np.arange(len(terms))
    df, passages, texts = term_counts(numbered, own, len(terms), p)
    # common terms first, so that most sums of products and vectors lie together in memory
    order = np.argsort(-df, kind="stable")
    words = list(terms)
    terms, df = {words[k]: i for i, k in enumerate(order.tolist())}, df[order]
    own[[vocabulary[w] for w in terms]] = np.arange(len(terms))
    # squared, so that what nearly every passage holds counts for nearly nothing
    idf = np.log((passages + 2.0) / (df + 1.0)) ** 2 + 1e-3
    products = term_products(numbered, own, idf, p)
    latent = latent_space(products, [list(x.words) for x in found], terms, idf, min(1.0, p.fit_docs / max(1, texts)), p)
    vectors = (idf[:, None] * latent).astype(np.float32)
    targets = np.stack([vectors[[terms[w] for w in x.words]].sum(0) for x in found])
    lengths = np.maximum(np.linalg.norm(targets, axis=1), 1e-12)
    targets /= lengths[:, None]
    weight = dict(zip(terms, idf.tolist()))
    return Space(p, terms, vectors, found, targets.astype(np.float32), lengths.astype(np.float32), weight, idf, Runs.of(items, terms, p.run), own)


def common_subsequence(words: tuple[str, ...], text: list[str]) -> int:
    """Length of the longest common subsequence, by bit operations on one integer."""
    masks: dict[str, int] = {}
    for i, w in enumerate(words):
        masks[w] = masks.get(w, 0) | 1 << i
    whole = state = (1 << len(words)) - 1
    for w in text:
        if w in masks:
            hit = state & masks[w]
            state = ((state + hit) | (state - hit)) & whole
    return len(words) - state.bit_count()


def enough(words: tuple[str, ...], text: list[str], weight: dict[str, float], share: float) -> bool:
    """Whether the text holds words that make up that share of the piece's weight.

    Common words weigh next to nothing, so a text that shares only them does not pass.
    """
    own = Counter(words)
    both = own & Counter(w for w in text if w in own)
    return sum(n * weight[w] for w, n in both.items()) >= share * sum(n * weight[w] for w, n in own.items())


def candidates(space: Space, found: Passages) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, piece, first word, words, cosine) of the passages near a piece in the latent space.

    A hit needs terms of the weight that ``enough`` asks for. A passage with less around it
    can be none whatever its place in the space, so its sums and products are left out.
    """
    p = space.params
    starts = {}
    for width in p.widths:
        at = np.flatnonzero(found.starts(width))
        starts[width] = at[found.held(space.idf, at, width) >= space.least]
    joined = found.joined(space.vectors, starts)
    for width, at in starts.items():
        sums = joined[width]
        length = np.maximum(np.linalg.norm(sums, axis=1), 1e-12)
        # no passage reaches farther along a piece than its own vector is long
        far = np.flatnonzero(length >= p.held * space.lengths.min() * (1 - 1e-5))
        at, sums, length = at[far], sums[far], length[far]
        for k in range(0, len(at), 4096):
            along = sums[k : k + 4096] @ space.targets.T
            # a passage that holds much of a piece reaches far along the piece's vector
            a, b = np.divmod(np.flatnonzero(along >= p.held * space.lengths), along.shape[1])
            cosine = along[a, b] / length[k + a]
            for row, piece, value in zip(*(x[cosine >= p.cosine].tolist() for x in (k + a, b, cosine))):
                start = at[row]
                yield int(found.doc[start]), piece, int(start - found.first[start]) * p.step, width * p.step, value


def hits(space: Space, texts: list[list[str]]) -> dict[tuple[int, int], tuple]:
    """(text, item) to (cosine, common share, answer share, first word, end word) of what is contaminated."""
    return hits_in(space, Passages.of(texts, space.terms, space.params.step), texts.__getitem__)


def hits_in(space: Space, found: Passages, words_of: Callable[[int], list[str]]) -> dict[tuple[int, int], tuple]:
    """As ``hits``; ``words_of`` gives the words of a text, asked for only where something is near."""
    p = space.params
    out: dict[tuple[int, int], tuple] = {}
    texts = Kept(words_of)
    for doc, piece, start, size, cosine in candidates(space, found):
        x = space.pieces[piece]
        low, high = max(0, start - p.step), start + size + p.step
        near = texts[doc][low:high]
        if not enough(x.words, near, space.weight, p.fair):
            continue
        share = common_subsequence(x.words, near) / len(x.words)
        if share < p.fair:
            continue
        answer = common_subsequence(x.answer, texts[doc][low : high + p.piece]) / len(x.answer)
        if share >= p.strong or answer >= p.answer:
            key, value = (doc, x.item), (share, cosine, answer, low, min(high, len(texts[doc])))
            if key not in out or value > out[key]:
                out[key] = value
    excerpts: dict[tuple[int, int], tuple[int, int]] = {}
    for doc, item, first, end in space.runs.shared(found.words):
        best = excerpts.get((doc, item), (0, 0))
        if (doc, item) not in out and end - first > best[1] - best[0]:
            excerpts[doc, item] = (first, end)
    for (doc, item), (first, end) in excerpts.items():
        out[doc, item] = excerpt(space, texts[doc], found.words[doc], item, first, end)
    return out


class Kept(dict):
    """Words of the texts asked for."""

    def __init__(self, words_of: Callable[[int], list[str]]):
        super().__init__()
        self.words_of = words_of

    def __missing__(self, doc: int) -> list[str]:
        self[doc] = self.words_of(doc)
        return self[doc]


def excerpt(space: Space, text: list[str], words: np.ndarray, item: int, first: int, end: int) -> tuple:
    """The values of ``hits`` for the words ``first`` to ``end``, by the item's piece that has most of them."""
    sums = space.vectors[words[first:end]].sum(0)
    length = max(float(np.linalg.norm(sums)), 1e-12)
    share, cosine, answer = max(
        (common_subsequence(x.words, text[first:end]) / len(x.words), float(space.targets[k] @ sums) / length,
         common_subsequence(x.answer, text[first : end + space.params.piece]) / len(x.answer))
        for k, x in enumerate(space.pieces) if x.item == item
    )
    return share, cosine, answer, first, end


def search(docs: DataFrame, space: Space) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(space)
    names = ["item_id", "cosine", "common_share", "answer_share", "span_start", "span_end"]
    kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            texts = batch.column("text")
            at, out = [], []
            for first, found in numbered_passages(batch.column("terms").to_pylist(), space):
                got = hits_in(space, found, lambda i: split_words(texts[first + i].as_py() or ""))
                for (i, item), (share, cosine, answer, low, high) in sorted(got.items()):
                    spans = word_spans(texts[first + i].as_py())
                    at.append(first + i)
                    out.append((item, cosine, share, answer, spans[low][0], spans[high - 1][1]))
            columns = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["id", *names]
            )

    kind = docs.schema["id"].dataType.simpleString()
    ddl = f"id {kind}, item_id long, cosine double, common_share double, answer_share double, span_start long, span_end long"
    return docs.select("id", "text", "terms").mapInArrow(run, ddl)


def numbered_passages(packed: list[bytes], space: Space) -> Iterator[tuple[int, Passages]]:
    """Runs of texts: where one starts, and its passages."""
    for first, held in _grouped(packed, space.own, space.params):
        yield first, Passages.numbered(held, space.params.step)


def spaces(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, p: Params) -> list[Space]:
    """The latent space of every block of the benchmark; ``docs`` has a text."""
    return prepared(docs, "text", benchmark, item_id, item_text, p)[1]


def prepared(docs: DataFrame, text: str, benchmark: DataFrame, item_id: str, item_text: str, p: Params) -> tuple[DataFrame, list[Space]]:
    """``docs`` with their packed ``terms``, stored, and the latent space of every block of the benchmark.

    The vocabulary, all distinct words of the benchmark, is numbered on the driver.
    """
    items = (
        benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text"))
        .where("item is not null and text is not null").distinct()
    )
    blocks = -(-items.count() // p.block_items)

    def block(b: int) -> list[tuple[int, str]]:
        return sorted((r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect())

    vocabulary: dict[str, int] = {}
    for b in range(blocks):
        for _, value in block(b):
            for w in split_words(value):
                vocabulary.setdefault(w, len(vocabulary))
    if not vocabulary:
        return docs, []
    numbered = stored(docs.withColumn("terms", numbers_of(F.col(text), vocabulary)), "contamination-terms")
    found = [fit(numbered, vocabulary, block(b), p) for b in range(blocks)]
    return numbered, [x for x in found if x is not None]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    params: Params | None = None,
) -> DataFrame:
    """One row per document and benchmark item found in it.

    Columns: id, ``item_id``, ``cosine``, ``common_share`` (of a piece's words that the
    document has in order), ``answer_share``, and the characters ``span_start`` to
    ``span_end`` of the passage in the text as it is. Null and empty texts hold no words and
    match nothing; whole texts of any length are searched. An item without words, or with a
    null id, is left out; repeated rows are searched each, and an item listed twice counts
    once. Of equally good passages for an item the later one is reported. Other columns are
    left out, and an empty table gives an empty result.
    """
    taken = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    numbered, every = prepared(taken, "text", benchmark, item_id, item_text, params or Params())
    found = [search(numbered, x) for x in every]
    if not found:
        found = [taken.where(F.lit(False)).select(
            "id", F.lit(0).cast("long").alias("item_id"), *(F.lit(0.0).alias(c) for c in ("cosine", "common_share", "answer_share")),
            *(F.lit(0).cast("long").alias(c) for c in ("span_start", "span_end")))]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("id", doc_id)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params | None = None
) -> DataFrame:
    """The documents in which no benchmark item is found, with their own columns; every row is judged by itself.

    Null and empty texts hold no item and stay, and so does everything if the benchmark is
    empty. Extra columns, whatever their names, and repeated rows stay; an empty table gives
    an empty one.
    """
    place = next(i for i, c in enumerate(docs.columns) if c.lower() == text.lower())
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    numbered, every = prepared(plain, f"c{place}", benchmark, "item_id", "text", params or Params())
    if not every:
        return docs
    for space in every:
        numbered = numbered.where(~_holds_item(docs.sparkSession.sparkContext.broadcast(space))(F.col(f"c{place}"), F.col("terms")))
    return numbered.select(*plain.columns).toDF(*docs.columns)


def _holds_item(shared):
    def found(texts: pd.Series, packed: pd.Series) -> pd.Series:
        out, space = np.zeros(len(texts), bool), shared.value
        for first, passages in numbered_passages(packed.tolist(), space):
            got = hits_in(space, passages, lambda i: split_words(texts.iloc[first + i] or ""))
            out[[first + i for i, _ in got]] = True
        return pd.Series(out)

    return F.pandas_udf(found, "boolean")
