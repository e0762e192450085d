"""Fill-in-the-middle: texts cut at two code points, found by word-parallel selection.

The UTF-8 of a batch is laid out in 64-bit words, each text from a new word on. In every
word arithmetic marks the bytes that end a code point: the byte after them is no
continuation byte. The marks of each word are counted, a search in the running counts finds
the word that holds the k-th code point's end, and a prefix sum inside that one word finds
the byte. No text is decoded. One pass without a shuffle; the cuts depend on the id only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import stretches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

_HIGH = np.uint64(0x8080808080808080)
_ONES = np.uint64(0x0101010101010101)
_ONE, _SEVEN, _EIGHT, _TOP = (np.uint64(n) for n in (1, 7, 8, 56))


@dataclass(frozen=True)
class Params:
    """``plain_percent`` of the texts stay as they are, ``spm_percent`` of the others start
    with the suffix. ``seed`` starts the hashed text. ``batch_bytes`` bounds what is laid
    out at once, unless one text alone is longer; no result depends on it."""

    seed: int = 1
    plain_percent: int = 10
    spm_percent: int = 20
    batch_bytes: int = 1 << 22


class Units:
    """Where the code points of texts end. A text is a run of whole words."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        held = -(-sizes // 8)
        self.first = np.cumsum(held) - held
        raw = b"".join(t + bytes(-len(t) % 8) for t in texts)
        words = np.frombuffer(raw, "<u8")
        # a continuation byte has its top bit set and the next one clear
        begins = ~(words & ~(words << _ONE)) & _HIGH
        after = np.append(begins[1:], _HIGH)
        after[self.first[held > 0] + held[held > 0] - 1] = _HIGH
        ends = (begins >> _EIGHT) | ((after & np.uint64(0x80)) << _TOP)
        # padding bytes end nothing
        spare = (-sizes % 8).astype(np.uint64)[held > 0]
        last = (self.first + held - 1)[held > 0]
        ends[last] &= ~np.uint64(0) >> (_EIGHT * spare)
        self.marks = ends >> _SEVEN
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])
        self.count = self.upto[self.first + held] - self.upto[self.first]

    def offsets(self, units: np.ndarray) -> np.ndarray:
        """Of each text, the bytes that its first ``units`` code points take."""
        out = np.zeros(len(units), np.int64)
        some = np.flatnonzero(units > 0)
        if len(some):
            start = self.first[some]
            rank = self.upto[start] + units[some]
            word = np.searchsorted(self.upto, rank, "left") - 1
            left = (rank - self.upto[word]).astype(np.uint64)
            # byte k of the product counts the marks of bytes 0 to k
            running = (self.marks[word] * _ONES)[:, None].view(np.uint8).reshape(-1, 8)
            out[some] = (word - start) * 8 + (running < left[:, None]).sum(1) + 1
        return out


def draws(doc_id: object, p: Params) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the hash of seed and id; a null id counts as empty."""
    digest = hashlib.sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4]) for k in range(0, 16, 4))


def assemble(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == PSM:
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == SPM:
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return prefix + middle + suffix


def restore(form: str, output: bytes) -> bytes:
    """The text that ``output`` was made from. Texts that hold a marker are never cut."""
    if form == PLAIN:
        return output
    first, second = (PREFIX, SUFFIX) if form == PSM else (SUFFIX, PREFIX)
    at = output.index(second)
    end = output.index(MIDDLE, at)
    one, two, middle = output[len(first) : at], output[at + len(second) : end], output[end + len(MIDDLE) :]
    return one + middle + two if form == PSM else two + middle + one


def transform(ids: list, texts: list[bytes], p: Params) -> list[tuple]:
    """(n, form, output, prefix units, middle units) of each text."""
    units = Units(texts)
    drawn = [draws(i, p) for i in ids]
    n = units.count
    cuts = np.array([[h[0] % (int(k) + 1), h[1] % (int(k) + 1)] for h, k in zip(drawn, n)], np.int64).reshape(-1, 2)
    low, high = cuts.min(1, initial=1 << 62), cuts.max(1, initial=0)
    ends = np.stack([units.offsets(low), units.offsets(high)], 1)
    out = []
    for h, text, count, a, b, (x, y) in zip(drawn, texts, n.tolist(), low.tolist(), high.tolist(), ends.tolist()):
        if not text or h[2] % 100 >= 100 - p.plain_percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
            out.append((count, PLAIN, text, None, None))
        else:
            form = SPM if h[3] % 100 < p.spm_percent else PSM
            out.append((count, form, assemble(form, text[:x], text[x:y], text[y:]), a, b - a))
    return out


def _mapped(docs: DataFrame, doc_id: str, text: str, p: Params, fields: list[tuple[str, str, pa.DataType]], values) -> DataFrame:
    """id and the columns ``fields``, taken from ``values(output of transform)``."""
    taken = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for a, b in stretches(batch.column("text"), p.batch_bytes):
                made = [values(x) for x in transform(ids[a:b], batch.column("text").slice(a, b - a).to_pylist(), p)]
                columns = [pa.array(c, kind) for c, (_, _, kind) in zip(zip(*made), fields)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), *columns], names=["id", *(f[0] for f in fields)])

    kind = taken.schema["id"].dataType.simpleString()
    return taken.mapInArrow(run, ", ".join([f"id {kind}", *(f"{name} {sql}" for name, sql, _ in fields)])).withColumnRenamed("id", doc_id)


_COMMON = [("n", "long", pa.int64()), ("form", "string", pa.string())]
_CHARS = [("prefix_chars", "long", pa.int64()), ("middle_chars", "long", pa.int64())]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params | None = None) -> DataFrame:
    """One row per document: id, ``n`` (code points), ``form``, ``output``, ``prefix_chars``, ``middle_chars``.

    ``output`` is the whole text, cut into three and put together with markers; ``form``
    tells how (``psm``, ``spm``), or that the text stays as it is (``plain``, then the
    lengths are null): empty and null texts, texts that hold a marker, and the drawn share.
    A null id counts as empty text, repeated rows and equal ids draw alike, a cut may leave
    parts empty, and a text of any length is cut as a whole. Other columns are left out,
    whatever their names; an empty table gives an empty result.
    """
    fields = [*_COMMON, ("output", "string", pa.string()), *_CHARS]
    return _mapped(docs, doc_id, text, params or Params(), fields, lambda x: (*x[:2], x[2].decode("utf-8", "replace"), *x[3:]))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params | None = None) -> DataFrame:
    """As ``fill_in_middle``, with hashes of the output and of the text restored from it.

    Columns: id, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output_sha256``,
    ``restored_sha256`` (of the UTF-8, lower-case hex). Cases as there.
    """

    def values(made: tuple) -> tuple:
        n, form, output, prefix, middle = made
        hashes = (hashlib.sha256(x).hexdigest() for x in (output, restore(form, output)))
        return n, form, prefix, middle, *hashes

    fields = [*_COMMON, *_CHARS, ("output_sha256", "string", pa.string()), ("restored_sha256", "string", pa.string())]
    return _mapped(docs, doc_id, text, params or Params(), fields, values)
