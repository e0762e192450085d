"""Language identification by bit-sliced Bloom filters of character n-grams.

One table of words holds a Bloom filter for every language at once: bit l of a slot
belongs to language l. A lookup ands the slots of an n-gram's hashes and so returns all
languages that contain it. A text's hits per language, corrected for the filter's
false positives, decide.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import cut, fold, mix64, pieces, rows, texts_of

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    """``docs_per_lang``: texts of a language that training takes on average, a bounded
    sample drawn by a hash of the id. ``grams_per_lang``: its commonest n-grams that enter
    the filter, unless they are ``contrast`` times as common elsewhere."""

    sizes: tuple[int, ...] = (3, 4, 5)
    docs_per_lang: int = 2000
    grams_per_lang: int = 30_000
    contrast: float = 8.0
    bits: int = 18
    hashes: int = 3
    chunk_chars: int = 1_000_000


@cache
def kinds() -> np.ndarray:
    """For every code point: 2 a letter, 1 a mark, 0 anything else."""
    first = (unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    return np.fromiter(({"L": 2, "M": 1}.get(x, 0) for x in first), np.uint8, sys.maxunicode + 1)


def grams(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n: text numbers and 64-bit hashes of the n-grams of letters, marks and single blanks.

    Texts are lower-cased and what is neither letter nor mark is a blank. The third item has
    the number of letters in each text.
    """
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    kind = kinds()[codes]
    n_letters = np.bincount(owner[kind == 2], minlength=len(texts))
    part = kind > 0
    codes = np.where(part, codes, 32)
    keep = part | np.concatenate([[True], part[:-1] | (owner[1:] != owner[:-1])])
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    for n in sizes:
        if len(codes) < n:
            continue
        code = np.zeros(len(codes) - n + 1, np.uint64)
        for k in range(n):
            code = code * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - n + 1 + k] + np.uint64(n)
        whole = owner[: len(owner) - n + 1] == owner[n - 1 :]
        yield owner[: len(owner) - n + 1][whole], mix64(code[whole]), n_letters


@dataclass(frozen=True)
class Filters:
    """``slots[s, w]``: bits of the languages ``64 w`` to ``64 w + 63``."""

    langs: list[str]
    slots: np.ndarray
    fills: np.ndarray
    params: Params

    @staticmethod
    def build(langs: list[str], members: list[np.ndarray], params: Params) -> Filters:
        size = 1 << params.bits
        slots = np.zeros((size, max(1, -(-len(langs) // 64))), np.uint64)
        fills = np.zeros(len(langs))
        for i, codes in enumerate(members):
            held = np.zeros(size, bool)
            for at in positions(codes, params):
                held[at] = True
            slots[held, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            fills[i] = held.mean()
        return Filters(langs, slots, fills, params)

    def languages(self, codes: np.ndarray) -> np.ndarray:
        """Bit masks of the languages that contain each n-gram."""
        masks = None
        for at in positions(codes, self.params):
            masks = self.slots[at] if masks is None else masks & self.slots[at]
        return masks

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits per text and language, and letters per text."""
        counts, total, found = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts)), np.zeros(len(texts))
        for owner, codes, found in grams(texts, self.params.sizes):
            masks = self.languages(codes)
            total += np.bincount(owner, minlength=len(texts))
            for i in range(len(self.langs)):
                bit = (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
                counts[:, i] += np.bincount(owner, weights=bit, minlength=len(texts))
        wrong = self.fills**self.params.hashes
        return np.maximum(0, (counts - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9)), found

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text. Texts beyond ``chunk_chars`` are read in parts
        of that size whose hits are added."""
        size = self.params.chunk_chars
        parts = [(i, t[k : k + size]) for i, t in enumerate(texts) for k in range(0, max(1, len(t)), size)]
        owner, parts = np.array([i for i, _ in parts], np.int64), [t for _, t in parts]
        hits, found = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for start, end in pieces(parts, size):
            h, n = self.hits(parts[start:end])
            np.add.at(hits, owner[start:end], h)
            np.add.at(found, owner[start:end], n)
        names, scores = [], []
        for h, n in zip(hits, found):
            known = n > 0 and len(self.langs) > 0
            best = int(h.argmax()) if known else 0
            names.append(self.langs[best] if known else UNKNOWN)
            scores.append((float(h[best] / h.sum()) if h.sum() > 0 else 1 / len(self.langs)) if known else 0.0)
        return names, scores


def positions(codes: np.ndarray, params: Params) -> Iterator[np.ndarray]:
    """Slots of each n-gram, one for each hash function: disjoint parts of its 64 bits."""
    width = min(params.bits, 64 // params.hashes)
    for k in range(params.hashes):
        yield ((codes >> np.uint64(k * width)) & np.uint64((1 << params.bits) - 1)).astype(np.int64)


def train(docs: DataFrame, params: Params) -> Filters:
    """Filters learnt from rows (id, text, lang) with known languages.

    Sampled texts are counted in Spark: n-grams per language are summed within a task,
    then over tasks; the commonest of each language, a bounded number, come to the driver.
    """
    known = docs.where(F.col("lang").isNotNull())
    sizes = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Filters.build([], [], params)
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, params.docs_per_lang / sizes[lang]))))
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    gram_sizes, chunk = params.sizes, params.chunk_chars

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, names = texts_of(batch), batch.column("lang").to_pylist()
            for lang in set(names):
                own = [t for t, x in zip(texts, names) if x == lang]
                for start, end in pieces(own, chunk):
                    for _, codes, _ in grams(own[start:end], gram_sizes):
                        unique, n = np.unique(codes, return_counts=True)
                        yield rows(schema, lang=[lang] * len(unique), gram=unique.view(np.int64), n=n)

    counted = (
        known.where(draw < share[F.col("lang")]).select("text", "lang")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("gram", "lang").agg(F.sum("n").alias("n"))
        .where("n >= 2")
    )
    per_gram = counted.groupBy("gram").pivot("lang", langs).agg(F.sum("n")).fillna(0)
    per_gram = cut(per_gram)
    totals = per_gram.agg(*(F.sum(F.col(f"`{lang}`")).alias(f"t{i}") for i, lang in enumerate(langs))).first()
    members = []
    for i, lang in enumerate(langs):
        rate = lambda j: F.col(f"`{langs[j]}`") / F.lit(float(totals[j] or 1))
        most = F.greatest(F.lit(0.0), F.lit(0.0), *(rate(j) for j in range(len(langs)) if j != i))
        top = (
            per_gram.where((F.col(f"`{lang}`") > 0) & (most < params.contrast * rate(i)))
            .orderBy(F.desc(f"`{lang}`"), "gram").limit(params.grams_per_lang).select("gram").toPandas()
        )
        members.append(top["gram"].to_numpy(np.int64).view(np.uint64))
    return Filters.build(langs, members, params)


def language_id(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    parts: int = 4,
    held_out: int = 2,
    params: Params | None = None,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``.

    Learns from rows with a language whose crc32(id) modulo ``parts`` is not
    ``held_out``; a null id counts as empty text. A null text, or one without letters
    (marks alone are none), is ``und`` with score 0, and so is every text if no language was learnt. A text
    with letters but no hit gets the first language with score 1 / languages; ties go
    to the alphabetically first. Repeated rows are predicted each; other columns are
    left out.
    """
    params = params or Params()
    taken = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
        (fold(doc_id, parts) == held_out).alias("held_out"),
    )
    filters = docs.sparkSession.sparkContext.broadcast(train(taken.where(~F.col("held_out")), params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = filters.value.predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["id", "held_out", "lang_pred", "score"],
            )

    kind = taken.schema["id"].dataType.simpleString()
    found = taken.select("id", "held_out", "text").mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double")
    return found.withColumnRenamed("id", doc_id)
