"""Vector compression by product codes, with Lloyd rounds that mostly skip distances.

A vector's components become integers and are cut into equal parts; each part is coded by
the nearest entry of its position's codebook. Rounds follow Drake and Hamerly's adaptive
bounds: a row keeps, for each part, its entry, the next ``b`` closest entries with lower
bounds of their distances in rising order, and one outer bound for all further entries.
After the entries moved, bounds are lowered by how far. A part whose entry is nearer than
every bound keeps it; entries whose bound does not exclude them are measured, and only a
part that the outer bound does not exclude is compared with the whole codebook. ``b`` falls
to what nearly all parts needed in the round before. Distances that decide are integers.

Spark deals the rows; a round is one pass that writes the rows with their bounds and, for
each task, sums of every entry's parts, which are added in Spark. The driver holds the
codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import discard, fresh_path, maybe_broadcast, stored

#: Larger components are held at this, so that distances fit in 64 bits.
MOST = 1 << 27

#: Doubles hold every integer below this.
EXACT = 1 << 53


@dataclass(frozen=True)
class Params:
    """``bounds`` is b at first; it falls to what ``cover`` of the parts needed. Neither changes a code."""

    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    bounds: int = 12
    least_bounds: int = 4
    cover: float = 0.98
    chunk_rows: int = 2048


def as_integers(values: np.ndarray, p: Params) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * p.scale), -MOST, MOST).astype(np.int64)


@dataclass
class Near:
    """Of each row's part: its entry, the next closest entries, lower bounds of their distances, and of all others."""

    own: np.ndarray
    ids: np.ndarray
    low: np.ndarray
    outer: np.ndarray

    @staticmethod
    def blank(n: int, b: int) -> Near:
        return Near(np.zeros(n, np.int64), np.zeros((n, b), np.int64), np.zeros((n, b)), np.zeros(n))

    def narrowed(self, b: int) -> Near:
        """With ``b`` entries at most; the outer bound covers those left out."""
        if b >= self.ids.shape[1]:
            return self
        return Near(self.own, self.ids[:, :b], self.low[:, :b], np.minimum(self.outer, self.low[:, b]))

    def packed(self) -> np.ndarray:
        """A row of bytes each: entries, then bounds as halves, rounded down."""
        ids = np.concatenate([self.own[:, None], self.ids], 1).astype(np.uint8)
        low = _halves(np.concatenate([self.low, self.outer[:, None]], 1))
        return np.concatenate([ids, low.view(np.uint8)], 1)

    @staticmethod
    def unpacked(raw: np.ndarray, b: int) -> Near:
        ids = raw[:, : b + 1].astype(np.int64)
        low = np.ascontiguousarray(raw[:, b + 1 :]).view(np.float16).astype(np.float64)
        return Near(ids[:, 0], ids[:, 1:], low[:, :b], low[:, b])


def _halves(x: np.ndarray) -> np.ndarray:
    """The largest half-precision numbers that do not exceed ``x``; bounds only get weaker."""
    x = np.minimum(np.maximum(x, 0), 65504)
    half = x.astype(np.float16)
    return np.where(half.astype(np.float64) > x, np.nextafter(half, np.float16(-1)), half)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one entry each."""
    d = x - entries
    return (d * d).sum(1)


def whole_search(x: np.ndarray, book: np.ndarray, b: int) -> tuple[Near, np.ndarray]:
    """Each row's entry and bounds by comparison with the whole codebook, and its exact squared distance.

    The products are doubles. Where these cannot hold every integer, all entries within the
    rounding error of the smallest product are measured in integers.
    """
    xf, cf = x.astype(np.float64), book.astype(np.float64)
    ahead = (cf * cf).sum(1)[None, :] - 2 * (xf @ cf.T)
    far = ahead + (xf * xf).sum(1)[:, None]
    reach = int(max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)))
    size = 4 * x.shape[1] * reach * reach
    slack = 0.0 if size < EXACT else size * 2.0**-52 * (x.shape[1] + 4)
    own = far.argmin(1)
    if slack:
        row, entry = np.nonzero(far <= far.min(1, keepdims=True) + 2 * slack)
        exact = squared(x[row], book[entry])
        order = np.lexsort((entry, exact, row))
        own = entry[order[np.flatnonzero(np.diff(row[order], prepend=-1))]]
    best = squared(x, book[own])
    near = Near.blank(len(x), min(b, len(book) - 1))
    near.own = own
    far[np.arange(len(x)), own] = np.inf
    b = near.ids.shape[1]
    near.outer[:] = np.inf
    if b:
        if b < len(book) - 1:
            at = np.argpartition(far, b, axis=1)
            near.outer = _distance(np.take_along_axis(far, at[:, b : b + 1], 1)[:, 0] - slack)
            at = at[:, :b]
        else:
            at = np.argsort(far, axis=1)[:, :b]
        near.ids, near.low = at, _distance(np.take_along_axis(far, at, 1) - slack)
        _order(near, slice(None))
    return near, best


def _distance(square: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(square, 0))


def _order(near: Near, rows) -> None:
    order = np.argsort(near.low[rows], axis=1, kind="stable")
    near.ids[rows] = np.take_along_axis(near.ids[rows], order, 1)
    near.low[rows] = np.take_along_axis(near.low[rows], order, 1)


def follow(x: np.ndarray, book: np.ndarray, near: Near, moved: np.ndarray) -> tuple[Near, np.ndarray, np.ndarray]:
    """The rows' new entries and bounds after the entries moved, exact distances, and how many bounds each row needed.

    A row that the outer bound did not save needs one more than it has.
    """
    near = Near(near.own.copy(), near.ids.copy(), near.low - moved[near.ids], near.outer - moved.max(initial=0))
    b = near.ids.shape[1]
    best = squared(x, book[near.own])
    reach = np.sqrt(best) * (1 + 1e-12)
    open_ = near.low <= reach[:, None]
    needed = open_.sum(1)
    lost = near.outer <= reach
    some = np.flatnonzero(open_.any(1) & ~lost)
    if len(some):
        row, slot = np.nonzero(open_[some])
        entry = near.ids[some][row, slot]
        exact = squared(x[some[row]], book[entry])
        near.low[some[row], slot] = np.sqrt(exact) * (1 - 1e-12)
        order = np.lexsort((entry, exact, row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        take = (exact[first] < best[some]) | ((exact[first] == best[some]) & (entry[first] < near.own[some]))
        at, first = some[take], first[take]
        near.ids[at, slot[first]] = near.own[at]
        near.low[at, slot[first]] = np.sqrt(best[at]) * (1 - 1e-12)
        near.own[at], best[at] = entry[first], exact[first]
        _order(near, some)
    again = np.flatnonzero(lost)
    if len(again):
        fresh, best[again] = whole_search(x[again], book, b)
        near.own[again], near.ids[again], near.low[again], near.outer[again] = fresh.own, fresh.ids, fresh.low, fresh.outer
        needed[again] = b + 1
    return near, best, needed


@dataclass(frozen=True)
class Round:
    """What a pass needs: codebooks (part, entry, component), how far entries moved, and b before and now."""

    books: np.ndarray
    moved: np.ndarray | None
    had: int
    bounds: int


def _vectors(column: pa.Array, dim: int, p: Params) -> np.ndarray:
    if pa.types.is_binary(column.type):
        return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)
    return as_integers(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), p)


def assign(x: np.ndarray, raw: np.ndarray | None, r: Round) -> Iterator[tuple[int, Near, np.ndarray, np.ndarray | None]]:
    """(part, rows' entries and bounds, exact distances, bounds needed) of every part; ``raw`` holds packed bounds."""
    width = r.books.shape[2]
    each = (r.had + 1) + 2 * (r.had + 1)
    for k, book in enumerate(r.books):
        own = x[:, k * width : (k + 1) * width]
        if raw is None:
            near, best = whole_search(own, book, r.bounds)
            yield k, near, best, None
        else:
            near = Near.unpacked(raw[:, k * each : (k + 1) * each], r.had).narrowed(r.bounds)
            yield k, *follow(own, book, near, r.moved[k])


STATE = "id {id}, label {label}, vector binary, near binary, slot int, n long, sums array<long>"


def _pass(rows: DataFrame, r: Round, dim: int, p: Params, path: str) -> None:
    """Writes the rows with new bounds, and for each task the count and the sums of every entry's parts.

    ``slot`` is null for rows, part and entry for sums, and -1 - n for how many parts needed n bounds.
    """
    shared = rows.sparkSession.sparkContext.broadcast(r)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    fields = [("vector", pa.binary()), ("near", pa.binary()), ("slot", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        parts, entries, width = r.books.shape
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        needs = np.zeros(r.bounds + 2, np.int64)
        types = None
        for batch in batches:
            types = batch.column("id").type, batch.column("label").type
            for a in range(0, batch.num_rows, p.chunk_rows):
                part = batch.slice(a, p.chunk_rows)
                x = _vectors(part.column("vector"), dim, p)
                raw = np.frombuffer(b"".join(part.column("near").to_pylist()), np.uint8).reshape(len(x), -1) if r.moved is not None else None
                packed = []
                for k, near, _, needed in assign(x, raw, r):
                    packed.append(near.packed())
                    order = np.argsort(near.own, kind="stable")
                    first = np.flatnonzero(np.diff(near.own[order], prepend=-1))
                    at = k * entries + near.own[order[first]]
                    total[at] += np.add.reduceat(x[order, k * width : (k + 1) * width], first)
                    count[at] += np.diff(np.append(first, len(order)))
                    if needed is not None:
                        needs += np.bincount(needed, minlength=len(needs))
                bounds = np.concatenate(packed, 1)
                none = [pa.nulls(len(x), t) for _, t in fields[2:]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), _binary(x.astype("<i4")), _binary(bounds), *none],
                    names=["id", "label", *(n for n, _ in fields)],
                )
        slots = np.flatnonzero(count)
        if types and len(slots):
            need = np.flatnonzero(needs)
            at, n = [*slots.tolist(), *(-1 - need).tolist()], [*count[slots].tolist(), *needs[need].tolist()]
            values = [at, n, [*total[slots].tolist(), *[None] * len(need)]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(at), t) for t in (*types, pa.binary(), pa.binary())), *(pa.array(v, t) for v, (_, t) in zip(values, fields[2:]))],
                names=["id", "label", *(n for n, _ in fields)],
            )

    rows.mapInArrow(run, STATE.format(**kinds)).write.parquet(path)


def _binary(rows: np.ndarray) -> pa.Array:
    raw = np.ascontiguousarray(rows)
    size = raw.shape[1] * raw.itemsize
    offsets = np.arange(len(raw) + 1, dtype=np.int32) * size
    return pa.BinaryArray.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry moved, at least."""
    d = (new - old).astype(np.float64)
    return np.sqrt((d * d).sum(2)) * (1 + 1e-12) + 1e-9


def _updated(written: DataFrame, books: np.ndarray, bounds: int, p: Params) -> tuple[np.ndarray, int]:
    """New codebooks, floor(sum / count) of every used entry, and b for the next pass."""
    parts, entries, width = books.shape
    sums = written.where("slot is not null").groupBy("slot").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(width))
    )
    new, needs = books.copy(), np.zeros(bounds + 2, np.int64)
    for row in sums.collect():
        if row["slot"] >= 0:
            new[row["slot"] // entries, row["slot"] % entries] = [row[f"s{k}"] // row["n"] for k in range(width)]
        else:
            needs[-1 - row["slot"]] = row["n"]
    met = needs[: bounds + 1]
    if met.sum():
        bounds = max(p.least_bounds, int(np.searchsorted(np.cumsum(met), p.cover * met.sum())))
    return new, min(bounds, p.bounds)


@dataclass(frozen=True)
class Compressed:
    """``rows``: id, label, code, error; ``books``: the final codebooks (part, entry, component)."""

    rows: DataFrame
    books: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | None = "label", params: Params | None = None
) -> Compressed:
    """Codes of all vectors and the codebooks they refer to.

    Left out are rows whose vector is null, holds a null or non-finite component, or has
    another length than the commonest one that can be cut into equal parts (the longest of
    equally common ones). Codebooks start from the rows with the smallest ids; of equal ids
    the smaller vector is first, null ids are last but coded like others, and repeated rows
    are coded each. Fewer rows than entries give smaller codebooks. Components beyond 2^27
    after scaling count as that. Of equally near entries the lower index is taken. Without
    usable rows the result is empty. Other columns are left out.
    """
    p = params or Params()
    if p.entries > 256:
        raise ValueError("entries are numbered by one byte")
    spark = vectors.sparkSession
    tag = F.col(f"`{label}`") if label else F.lit(None).cast("int")
    kept = vectors.select(F.col(f"`{vec_id}`").alias("id"), tag.alias("label"), F.col(f"`{vector}`").alias("vector")).where(usable(F.col("vector")))
    sizes = kept.groupBy(F.size("vector").alias("d")).count().where((F.col("d") > 0) & (F.col("d") % p.parts == 0))
    found = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    empty = "id {id}, label {label}, code string, error long".format(**{c: kept.schema[c].dataType.simpleString() for c in ("id", "label")})
    if found is None:
        return Compressed(spark.createDataFrame([], empty), np.zeros((p.parts, 0, 0), np.int64))
    dim = found["d"]
    kept = kept.where(F.size("vector") == dim)
    first = kept.select("id", "vector").orderBy(F.asc_nulls_last("id"), "vector").limit(p.entries).collect()
    x = as_integers(np.array([r["vector"] for r in first], np.float64), p)
    books = np.ascontiguousarray(x.reshape(len(x), p.parts, -1).transpose(1, 0, 2))
    rows, path = kept, None
    r = Round(books, None, 0, min(p.bounds, len(x) - 1))
    for _ in range(p.rounds):
        before, path = path, fresh_path(spark, "vector-codes")
        _pass(rows, r, dim, p, path)
        if before:
            discard(spark, before)
        written = spark.read.schema(STATE.format(**{c: kept.schema[c].dataType.simpleString() for c in ("id", "label")})).parquet(path)
        after, bounds = _updated(written, r.books, r.bounds, p)
        r = Round(after, _moved(r.books, after), r.bounds, min(bounds, r.bounds))
        rows = written.where("slot is null").select("id", "label", "vector", "near")
    if not p.rounds:
        return Compressed(_coded(rows, r, dim, p), r.books)
    coded, final = _coded(rows, r, dim, p), fresh_path(spark, "vector-codes")
    coded.write.parquet(final)
    discard(spark, path)
    return Compressed(spark.read.schema(coded.schema).parquet(final), r.books)


def _coded(rows: DataFrame, r: Round, dim: int, p: Params) -> DataFrame:
    """id, label, code and error of every row by the final codebooks."""
    shared = rows.sparkSession.sparkContext.broadcast(replace(r, bounds=min(r.bounds, p.least_bounds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = shared.value
        for batch in batches:
            for a in range(0, batch.num_rows, p.chunk_rows):
                part = batch.slice(a, p.chunk_rows)
                x = _vectors(part.column("vector"), dim, p)
                raw = np.frombuffer(b"".join(part.column("near").to_pylist()), np.uint8).reshape(len(x), -1) if r.moved is not None else None
                codes, error = np.zeros((len(x), len(r.books)), np.uint8), np.zeros(len(x), np.int64)
                for k, near, best, _ in assign(x, raw, r):
                    codes[:, k] = near.own
                    error += best
                text = codes.tobytes().hex()
                size = 2 * codes.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), pa.array([text[k : k + size] for k in range(0, len(text), size)], pa.string()),
                     pa.array(error)], names=["id", "label", "code", "error"],
                )

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", "label")]
    return rows.mapInArrow(run, ", ".join([*kinds, "code string, error long"]))


def restored(compressed: Compressed, params: Params | None = None) -> DataFrame:
    """id and the vector that each code stands for."""
    p = params or Params()
    shared = compressed.rows.sparkSession.sparkContext.broadcast(compressed.books)
    parts = np.arange(p.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()], np.int64).reshape(-1, p.parts)
            vectors = (shared.value[parts, codes].reshape(len(codes), -1) / p.scale).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(vectors), pa.list_(pa.float32()))], names=["id", "vector"])

    kind = compressed.rows.schema["id"].dataType.simpleString()
    return compressed.rows.select("id", "code").mapInArrow(run, f"id {kind}, vector array<float>")


def vector_codes(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", params: Params | None = None
) -> DataFrame:
    """One row per coded vector: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    ``code`` has two hex digits for each part, ``error`` is the squared distance to the
    coded vector in integers, ``label_error`` its sum over the rows of equal labels (null
    labels together). Cases as in ``compress``.
    """
    found = compress(vectors, vec_id, vector, label, params)
    sums = found.rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    # labels are as many as the rows say: a broadcast only if they are few
    sums = maybe_broadcast(stored(sums, "vector-labels"))
    joined = found.rows.join(sums, found.rows["label"].eqNullSafe(sums["of"]))
    return joined.select(F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
