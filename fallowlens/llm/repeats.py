"""Repeated lines and sentences across documents: hash units, keep the earliest, cut the rest.

A text is divided into units, which end after a line break or after a full stop,
question or exclamation mark with a blank. A unit is normalised (A-Z lower-cased, white
space collapsed) and hashed. The digests are grouped over all documents; the occurrence
in the smallest doc_id, and there the first, is kept, and all others are removed. With
``min_words`` only those go that stand in a run of repeated units with so many words, so that
short lines and sentences which coincide stay. Offsets are those of the original text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fallowlens.llm.common import rows, stored, texts_of

_ENDS = re.compile(r"(?<=[.!?] )|(?<=\n)")


@dataclass(frozen=True)
class Params:
    """``min_words``: words of a run of repeated units from which on it is removed; 1 is every unit."""

    min_words: int = 1


#: For corpora in which common lines are no copies.
PASSAGES = Params(min_words=20)


def units(text: str) -> Iterator[tuple[bytes, int, int, int]]:
    """(normalised unit, start, end, words) of the units with words; offsets in code points."""
    start = 0
    for piece in _ENDS.split(text):
        found = piece.encode("utf-8", "replace").lower().split()
        if found:
            yield b" ".join(found), start, start + len(piece), len(found)
        start += len(piece)


def _unit_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    schema = pa.schema([
        ("id", pa.int64()), ("text_key", pa.int64()), ("digest", pa.binary()), ("idx", pa.int32()), ("start", pa.int32()),
        ("stop", pa.int32()), ("words", pa.int32()), ("again", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, key, text in zip(batch.column("id").to_pylist(), batch.column("text_key").to_pylist(), texts_of(batch)):
                seen = set()
                for idx, (unit, start, stop, n) in enumerate(units(text)):
                    digest = hashlib.blake2b(unit, digest_size=16).digest()
                    out.append((i, key, digest, idx, start, stop, n, digest in seen))
                    seen.add(digest)
                if len(out) > 50_000:
                    yield rows(schema, **dict(zip(schema.names, zip(*out))))
                    out = []
            if out:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))

    return (
        docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("text_key"), F.col(text).alias("text"))
        .mapInArrow(run, "id long, text_key long, digest binary, idx int, start int, stop int, words int, again boolean")
    )


def repeated_units(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", params: Params | None = None, keyed: bool = False
) -> DataFrame:
    """One row per unit to remove: id, ``unit_start``, ``unit_end``, ``n_words``, ``kept_doc_id``, ``kept_start``.

    Documents with a null or empty text, or a null id, have no units and none are
    removed from them. Rows that share an id count as one document's: their units are
    never repeats of each other across rows. Repeated rows give their units once. Whole
    texts are divided, of any length; equal units of one text count in their order. Other
    columns are left out, and an empty table gives an empty result. ``keyed`` adds a hash of the text that the offsets belong to.
    """
    params = params or Params()
    found = _unit_rows(docs, doc_id, text)
    fresh = ~F.col("again")
    # stored, so that the join deals both sides anew and Spark can split a digest that is common
    kept = stored(
        found.groupBy("digest")
        .agg(F.min("id").alias("kept_doc_id"),
             F.min_by(F.when(fresh, F.col("start")), F.when(fresh, F.col("id"))).alias("kept_start"),
             F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n"),
        "repeated-units",
    )
    own = ["id", "text_key"]
    order = Window.partitionBy(*own).orderBy("idx")
    run = Window.partitionBy(*own, "run")
    repeated = (
        found.join(kept.hint("merge"), "digest").where(F.col("again") | (F.col("id") > F.col("kept_doc_id")))
        .drop("digest", "again")
        .repartition(*own).distinct()
        .withColumn("run", F.col("idx") - F.row_number().over(order))
        .withColumn("run_words", F.sum("words").over(run))
        .where(F.col("run_words") >= params.min_words)
    )
    return repeated.select(
        F.col("id").alias(doc_id), F.col("start").cast("long").alias("unit_start"), F.col("stop").cast("long").alias("unit_end"),
        F.col("words").cast("long").alias("n_words"), "kept_doc_id", F.col("kept_start").cast("long").alias("kept_start"),
        *(["text_key"] if keyed else []),
    )


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", params: Params | None = None
) -> DataFrame:
    """The documents without their repeated units, with their own columns.

    ``n_chars``, if the table has it, is set to the new text's length where units were
    removed. A document of which nothing is left keeps its row with an empty text, and so
    does every row with a null text or id. Extra columns, whatever their names, and repeated
    rows stay; an empty table gives an empty one.
    """
    spans = (
        repeated_units(docs, doc_id, text, params, keyed=True)
        .groupBy(F.col(doc_id).alias("span_id"), F.col("text_key").alias("span_key"))
        .agg(F.sort_array(F.collect_list(F.struct("unit_start", "unit_end"))).alias("spans"))
    )
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own_text = F.col(f"row.`{text}`")
    joined = packed.join(
        spans.hint("merge"), (F.col(f"row.`{doc_id}`") == F.col("span_id")) & (F.xxhash64(own_text) == F.col("span_key")), "left"
    )
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["unit_end"]))
    ends = F.concat(F.transform("spans", lambda s: s["unit_start"]), F.array(F.length(own_text).cast("long")))
    rest = F.array_join(
        F.zip_with(starts, ends, lambda a, b: own_text.substr((a + 1).cast("int"), (b - a).cast("int"))), ""
    )
    joined = joined.withColumn("rest", F.when(F.col("spans").isNull(), own_text).otherwise(rest))

    def column(c: str):
        if c == text:
            return F.col("rest").alias(c)
        if c == n_chars:
            kind = docs.schema[c].dataType
            return F.when(F.col("spans").isNull(), F.col(f"row.`{c}`")).otherwise(F.length("rest").cast(kind)).alias(c)
        return F.col(f"row.`{c}`").alias(c)

    return joined.select(*(column(c) for c in docs.columns))
