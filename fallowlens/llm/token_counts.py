"""Token counts by a two-tier lookup of pre-token lengths, without any shuffle.

The lengths of frequent pre-tokens are broadcast as one table. A worker looks each
pre-token of a text up in it; what is missing is encoded by the tokenizer once and
kept in the worker's cache, which is emptied to the table when it is full. Both
tiers hold exact lengths, so the counts never depend on what the table holds.

Texts are divided by the library's own pre-tokenizer. For texts of Latin letters alone, whose
classes no version of Unicode has changed, an equal pattern does the same faster.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fallowlens.llm.common import rows, texts_of

#: Pre-token pattern of byte-level BPE tokenizers (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A code point above the blocks for which the pattern and the library agree on every one.
_BEYOND = regex.compile("[^\0-\u024f]")

SEPARATOR = "\0"


@dataclass(frozen=True)
class Params:
    """``table_size`` entries are broadcast: the commonest pre-tokens of about ``sample_rows``
    texts of at most ``sample_chars`` characters, drawn by a hash over all rows. ``cache_size``
    and ``cache_chars`` bound a worker's entries and their length. None of them changes a count."""

    max_tokens: int = 1024
    table_size: int = 16_384
    sample_rows: int = 500
    sample_chars: int = 65_536
    cache_size: int = 500_000
    cache_chars: int = 16_000_000


class Lengths(dict):
    """Pre-token to number of tokens; misses are encoded and kept, up to a number and a length in all."""

    def __init__(self, frequent: dict[str, int], tokenizer: Tokenizer, params: Params):
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.params, self.chars = frequent, tokenizer, params, 0

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(self) >= self.params.cache_size or self.chars + len(piece) > self.params.cache_chars:
            self.clear()
            self.update(self.frequent)
            self.chars = 0
        if len(piece) <= self.params.cache_chars:
            self[piece] = n
            self.chars += len(piece)
        return n


class Counting:
    """Counts tokens of texts as the library does for a byte-level BPE file."""

    def __init__(self, spec: str, frequent: dict[str, int], params: Params):
        self.tokenizer = Tokenizer.from_str(spec)
        self.pattern = regex.compile(PATTERN)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.lengths = Lengths(frequent, self.tokenizer, params)

    def parts(self, text: str) -> tuple[int, list[str]]:
        """Added tokens found in the text, and what lies between them."""
        if self.added is None:
            return 0, [text]
        found = self.added.split(text)
        return len(found) - 1, found

    def pieces(self, part: str) -> Iterable[str]:
        """Pre-tokens of a text without added tokens."""
        if _BEYOND.search(part):
            return (part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part))
        if len(part) < 1_000_000:
            return self.pattern.findall(part)
        return (m.group() for m in self.pattern.finditer(part))

    def count(self, text: str) -> int:
        n, parts = self.parts(text)
        get = self.lengths.__getitem__
        return n + sum(sum(map(get, self.pieces(part))) for part in parts)


def frequent_lengths(docs: DataFrame, spec: str, doc_id: str, text: str, params: Params) -> dict[str, int]:
    """Exact lengths of the commonest pre-tokens of a bounded sample of texts."""
    counting = Counting(spec, {}, params)
    seen: Counter[str] = Counter()
    share = min(1.0, params.sample_rows / max(1, docs.count()))
    draw = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.length(text)), F.lit(1 << 40))
    sample = docs.where((draw < int(share * (1 << 40))) & (F.length(text) <= params.sample_chars))
    # twice the expected rows, so that repeated ids cannot make the sample large
    for row in sample.select(F.col(text).alias("text")).take(2 * params.sample_rows):
        for part in counting.parts(row.text)[1]:
            seen.update(counting.pieces(part))
    top = {piece: counting.lengths[piece] for piece, _ in seen.most_common(params.table_size)}
    return {piece: n for piece, n in top.items() if n < 256 and SEPARATOR not in piece}


def token_counts(
    docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", params: Params | None = None
) -> DataFrame:
    """One row per document: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    The whole text is counted without begin, end or other added tokens; the string of
    an added token inside a text counts as that token. A null text counts as empty
    (0 bytes, 0 tokens), and a text of any length is counted whole. A null id stays null; repeated rows are counted each; an empty
    table gives an empty result. Other columns are left out, whatever their names.
    """
    params = params or Params()
    spec = Path(tokenizer_path).read_text()
    context = docs.sparkSession.sparkContext
    frequent = frequent_lengths(docs, spec, doc_id, text, params)
    shared = context.broadcast((spec, SEPARATOR.join(frequent), bytes(frequent.values())))
    schema = pa.schema([("n_tokens", pa.int64()), ("n_bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, keys, sizes = shared.value
        counting = Counting(spec, dict(zip(keys.split(SEPARATOR), sizes)), params)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *rows(schema, n_tokens=[counting.count(t) for t in texts_of(batch)],
                                           n_bytes=batch.column("n_bytes")).columns],
                names=["id", "n_tokens", "n_bytes"],
            )

    taken = docs.select(
        F.col(doc_id).alias("id"), F.col(text).alias("text"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = taken.schema["id"].dataType.simpleString()
    counted = taken.mapInArrow(run, f"id {kind}, n_tokens long, n_bytes long")
    return counted.select(
        F.col("id").alias(doc_id), "n_bytes", "n_tokens", (F.col("n_tokens") > params.max_tokens).alias("over_limit")
    )
