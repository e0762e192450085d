import datetime as dt
import json
import statistics

import pytest

from fallowlens.operators import quality as q
from fallowlens.schemas import SEEDS, STACKED_TILES, TILES

T0 = [10.0, 0.0, 0.0, 0.0, -10.0, 0.0]


def test_required_columns_and_bands(spark):
    df = spark.range(1)
    assert q.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="lat"):
        q.require_columns(df, ["lat"])
    with pytest.raises(ValueError, match="B12"):
        q.require_bands(["B02", "B03", "B04", "B08", "B11"])


def test_first_reason_per_seed_wins(spark):
    ids = ["good", "nodates", "short", "shape", "absent", "nowhere", "twice", "twice"]
    seeds = spark.createDataFrame([(i, None if i == "nowhere" else 45.0, 9.0) for i in ids], SEEDS)
    dates = json.dumps({"acquisition_dates": json.dumps(["2024-06-01T00:00:00Z"])})
    stacks = spark.createDataFrame(
        [(i, "{}" if i == "nodates" else dates, 1, 1, T0, [1.0] if i == "short" else [1.0, 2.0]) for i in set(ids) - {"absent"}],
        STACKED_TILES,
    )
    tiles = spark.createDataFrame(
        [
            (i, dt.date(2024, 6, d), 1 + (i == "shape" and d == 2), 1, T0, ["B04"], [1.0] * (1 + (i == "shape" and d == 2)))
            for i in set(ids) - {"absent"}
            for d in (1, 2)
        ],
        TILES,
    )
    found = [
        q.missing_errors(seeds, tiles),
        q.shape_errors(tiles),
        q.stack_errors(stacks, 2),
        q.duplicate_errors(seeds),
        q.coordinate_errors(seeds),
    ]
    errors = q.error_table(seeds, found)
    assert errors.columns == ["seed_id", "lat", "lon", "error"]
    assert sorted((r["seed_id"], r["error"]) for r in errors.collect()) == [
        ("absent", "no tiles"),
        ("nodates", "acquisition dates missing"),
        ("nowhere", "missing coordinates"),
        ("shape", "shape mismatch"),
        ("short", "band count mismatch"),
        ("twice", "duplicate seed_id"),
        ("twice", "duplicate seed_id"),
    ]
    assert [r["seed_id"] for r in q.without_errors(seeds, errors).collect()] == ["good"]


def test_profile(spark):
    df = spark.createDataFrame([(1, "x", 2.0), (3, None, 4.0), (3, "y", None)], "a int, s string, v double")
    got = {r["column"]: r for r in q.table_profile(df).collect()}
    assert got["a"]["mean"] == pytest.approx(7 / 3) and got["a"]["distinct"] == 2
    assert got["s"]["nulls"] == 1 and got["s"]["low"] == "x" and got["s"]["mean"] is None
    assert got["v"]["n_rows"] == 3 and got["v"]["std"] == pytest.approx(2**0.5)
    assert [tuple(r) for r in q.top_values(df, "a", 1).collect()] == [(3, 2)]
    assert [tuple(r) for r in q.duplicate_keys(df, "a").collect()] == [(3, 2)]


def test_medians_of_few_and_of_many_distinct_values(spark):
    """Columns with few values take their median from counts, others from ranked brackets; both are exact."""
    rows = [(i % 7, None if i % 5 == 0 else i * 0.5, "ab"[i % 2], None) for i in range(501)]
    df = spark.createDataFrame(rows, "few long, many double, name string, none double").repartition(4)
    profile = q.exact_profile(df, most=50)
    assert "percentile(number" in profile._jdf.queryExecution().toString()
    got = {r["column"]: (r["distinct"], r["median"]) for r in profile.collect()}
    middle = lambda c: statistics.median(v[c] for v in rows if v[c] is not None)
    assert got == {"few": (7, middle(0)), "many": (400, middle(1)), "name": (2, None), "none": (0, None)}
    assert {r["column"]: (r["distinct"], r["median"]) for r in q.exact_profile(df).collect()} == got
