"""Helpers shared by the operators: the shared folder, word rules, folds and checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a side that may be broadcast; more rows are joined by a shuffle.
SMALL_ROWS = 10_000

#: Bytes of its files.
SMALL_BYTES = 16_000_000


def shared_dir(spark: SparkSession) -> str:
    """A folder that the driver and all executors see.

    ``spark.checkpoint.dir`` if the session names it, else the context's own checkpoint
    folder. Where neither is set it is a folder in the warehouse, which on a cluster must not
    lie on one machine's disk.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        if warehouse.startswith("file:") and not context.master.startswith("local"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        context.setCheckpointDir(f"{warehouse}/_shared")
        named = context.getCheckpointDir()
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that its lineage ends there."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for ``discard`` when nothing reads it any more."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``fresh_path`` that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def maybe_broadcast(df: DataFrame, limit: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> DataFrame:
    """``df``, a stored frame, with a broadcast hint if it is small in rows and in bytes.

    The bytes are those of its files, which are read as they are.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    small = int(str(size)) <= most_bytes and len(df.limit(limit + 1).collect()) <= limit
    return F.broadcast(df) if small else df


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % parts


def words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text, divided by the six ASCII white-space characters."""
    return text.encode("utf-8", "replace").split() if text else []


def lowered_words(text: str | None) -> list[bytes]:
    """The words of a text after A-Z are lower-cased."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def cut_words(texts: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of an Arrow column of UTF-8 texts, one after another as bytes, and how many each text has.

    ``table`` translates bytes, and what it makes a blank stands between words. No Python value is
    made of a word. A null text has none.
    """
    texts = pc.fill_null(texts.cast(pa.binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = memoryview(held)[bounds[0] : bounds[-1]].tobytes().translate(table) if held is not None else b""
    bounds -= bounds[0]
    inside = np.frombuffer(data, np.uint8) != 32
    # a word begins after a blank or at its text's begin, and ends before a blank or at its text's end
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(bounds))
    begins[bounds[filled]] = inside[bounds[filled]]
    ends[bounds[filled + 1] - 1] = inside[bounds[filled + 1] - 1]
    first = np.flatnonzero(begins)
    sizes = np.zeros(len(first) + 1, np.int32)
    np.cumsum(np.flatnonzero(ends) + 1 - first, out=sizes[1:])
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(sizes), pa.py_buffer(data.translate(None, b" "))])
    return words, np.diff(np.searchsorted(first, bounds))


def numbers_in(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of every word in ``known``, -1 for others."""
    return pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts; null becomes the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, columns[f.name]) for f in schema)],
        schema=schema,
    )


def pieces(values: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive runs of texts with about ``size`` characters each."""
    start = held = 0
    for i, v in enumerate(values):
        held += len(v)
        if held >= size:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(values):
        yield start, len(values)


def stretches(values: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """As ``pieces``, for an Arrow column of texts or bytes and its bytes, without making Python values."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = 0
    while start < len(sizes):
        stop = start + 1 + int(np.searchsorted(np.cumsum(sizes[start:]), size))
        yield start, min(stop, len(sizes))
        start = min(stop, len(sizes))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder; for small frames that are used again at once."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
