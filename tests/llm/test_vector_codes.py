"""Vector codes against a plain version of the rounds, bounds, odd rows."""

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from fallowlens.llm import vector_codes as vc


def plainly(rows, parts=4, entries=256, rounds=4):
    """The contract with full distance tables in integers. ``rows`` are (id, vector, label)."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(1024 * v) for v in r[1]] for r in kept], np.int64)
    start = np.array([[math.floor(1024 * v) for v in r[1]] for r in order[:entries]], np.int64)
    width = x.shape[1] // parts
    codes, error, books = [], np.zeros(len(x), np.int64), []
    for k in range(parts):
        own, book = x[:, k * width : (k + 1) * width], start[:, k * width : (k + 1) * width].copy()
        for turn in range(rounds + 1):
            far = np.stack([((own - c) ** 2).sum(1) for c in book], 1)
            near = far.argmin(1)
            if turn < rounds:
                for e in range(len(book)):
                    if (near == e).any():
                        book[e] = own[near == e].sum(0) // (near == e).sum()
        codes.append(near)
        error += far.min(1)
        books += book.ravel().tolist()
    labels = pd.Series(error).groupby([str(r[2]) for r in kept]).sum()
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return sorted(
        (str(r[0]), "".join(f"{c[i]:02x}" for c in codes), int(error[i]), int(labels[str(r[2])]), digest) for i, r in enumerate(kept)
    )


def collected(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_query_equals_plain_rounds(spark, sf):
    table = pq.read_table(f"/root/testdata/{sf}/embeddings.parquet").to_pylist()
    want = plainly([(r["vec_id"], r["embedding"], r["label"]) for r in table])
    assert collected(entry.queries()["op13_vector_codes"](spark, f"/root/testdata/{sf}")) == want


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, id int")


def test_odd_rows_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-3, 4, 8).astype(float).tolist(), int(i % 3) or None, "x", 5) for i in range(400)]
    rows += [(7, rows[9][1], 1, "x", 5)] * 3 + [(None, rows[3][1], None, None, None)]
    good = list(rows)
    rows += [(900, None, 1, "", 1), (901, [1.0] * 7 + [None], 1, "", 1), (902, [1.0] * 7 + [float("nan")], 1, "", 1),
             (903, [1.0] * 7 + [float("inf")], 1, "", 1), (904, [1.0] * 7 + [float("-inf")], 1, "", 1), (-5, [], 1, "", 1),
             (-6, [1.0, 2.0, 3.0], 1, "", 1), (-7, [1.0] * 12, 1, "", 1)]
    want = plainly([r[:3] for r in good])
    assert collected(vc.vector_codes(frame(spark, rows))) == want
    # the same whatever b is
    assert collected(vc.vector_codes(frame(spark, rows), params=vc.Params(bounds=2, least_bounds=1, chunk_rows=7))) == want


def test_few_rows_and_none(spark):
    rows = [(3, [0.5, -0.5, 1.0, 2.0], 1, "", 1), (1, [0.25, 0.5, -1.0, 2.0], 1, "", 1)]
    assert collected(vc.vector_codes(frame(spark, rows))) == plainly([r[:3] for r in rows])
    assert collected(vc.vector_codes(frame(spark, rows[:1]))) == plainly([rows[0][:3]])
    assert vc.vector_codes(frame(spark, rows).limit(0)).count() == 0
    assert vc.vector_codes(frame(spark, [(1, None, 1, "", 1)])).count() == 0


def test_components_beyond_doubles_are_verified_in_integers():
    rng = np.random.default_rng(2)
    x = rng.integers(-vc.MOST, vc.MOST, (300, 4)) // 5 * 5
    book = np.concatenate([x[:20], x[:20] + rng.integers(-1, 2, (20, 4)), x[:3]])
    near, best = vc.whole_search(x, book, 5)
    far = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (near.own == far.argmin(1)).all() and (best == far.min(1)).all()
    extremes = vc.as_integers(np.array([[1e30, -1e30, 0.0]]), vc.Params())
    assert extremes.tolist() == [[vc.MOST, -vc.MOST, 0]]


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(3)
    x = rng.integers(-500, 500, (500, 8))
    book = x[:64].copy()
    near, _ = vc.whole_search(x, book, 6)
    for step in (0, 1, 5, 40):
        moved = book + rng.integers(-step, step + 1, book.shape)
        far = np.sqrt(((x[:, None] - moved[None]) ** 2).sum(2))
        near = vc.Near.unpacked(near.packed(), near.ids.shape[1])
        got, best, needed = vc.follow(x, moved, near, vc._moved(book[None], moved[None])[0])
        assert (got.own == (far**2).round().argmin(1)).all() and np.array_equal(np.sqrt(best), far.min(1))
        assert (got.low <= np.take_along_axis(far, got.ids, 1) + 1e-6).all()
        named = np.zeros(far.shape, bool)
        np.put_along_axis(named, np.concatenate([got.ids, got.own[:, None]], 1), True, 1)
        assert (got.outer <= np.where(named, np.inf, far).min(1) + 1e-6).all()
        assert step > 1 or (needed <= 6).mean() > 0.9
        near, book = got, moved


def test_restored_vectors_are_as_far_as_the_error_says(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist(), 0, "", 1) for i in range(600)]
    found = vc.compress(frame(spark, rows))
    errors = {r.id: r.error for r in found.rows.collect()}
    for r in vc.restored(found).collect():
        own = np.floor(np.array(rows[r.id][1], np.float32).astype(float) * 1024)
        assert ((own - np.array(r.vector) * 1024) ** 2).sum() == errors[r.id]
