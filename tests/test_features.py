import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fallowlens.operators.bare_soil import mask_min_obs, pixel_statistics
from fallowlens.operators.spatial import feature_columns, pixel_coverage, seed_statistics
from fallowlens.plans import batch
from fallowlens.schemas import (
    BANDS,
    Params,
    pixel_columns,
    seed_columns,
    temporal_names,
    timeseries_columns,
)
from fallowlens.sources import derived

SF = "/root/testdata/sf0.001"
OBS = "seed_id string, row int, col int, acq_date date, scene_idx long, cloud_cover int, " + ", ".join(
    f"{b} double" for b in BANDS
)
SEEDS = "seed_id string, lat double, lon double, transform array<double>"
T0 = [10.0, 0.0, 500000.0, 0.0, -10.0, 4970000.0]
BARE = (0.05, 0.07, 0.10, 0.14, 0.25, 0.20)
GREEN = (0.05, 0.07, 0.10, 0.40, 0.25, 0.20)


def day(n):
    return dt.date(2024, 6, n)


def obs(spark, rows):
    return spark.createDataFrame(
        [(s, r, c, day(d), i, cloud, *b) for s, r, c, d, i, cloud, b in rows], OBS
    )


def seeds(spark, *ids):
    return spark.createDataFrame([(s, 45.0, 9.0, T0) for s in ids], SEEDS)


def by_seed(run):
    return {r["seed_id"]: r for r in run.features.collect()}


def test_temporal_statistics(spark):
    df = spark.createDataFrame(
        [("a", 0, 0, 0.1), ("a", 0, 0, 0.3), ("a", 0, 1, 0.5), ("a", 0, 2, None)],
        "seed_id string, row int, col int, v double",
    )
    got = {r["col"]: r for r in pixel_statistics(df, ["seed_id", "row", "col"], ["v"]).collect()}
    assert got[0]["v_median_bs"] == pytest.approx(0.2)
    assert got[0]["v_mean_bs"] == pytest.approx(0.2)
    assert got[0]["v_std_bs"] == pytest.approx(0.1414213562)
    assert got[0]["n_obs_baresoil"] == 2
    assert got[1]["v_std_bs"] is None and got[1]["v_median_bs"] == 0.5
    # missing values are skipped by the statistics but counted as observations
    assert got[2]["n_obs_baresoil"] == 1 and got[2]["v_median_bs"] is None and got[2]["v_mean_bs"] is None


def test_masking_keeps_rows_and_count(spark):
    df = spark.createDataFrame(
        [("a", 0, 0, 0.1, 1), ("a", 0, 1, 0.3, 3)],
        "seed_id string, row int, col int, v double, n_obs_baresoil long",
    )
    keys = ["seed_id", "row", "col"]
    kept = mask_min_obs(df, 2, keys).orderBy("col").collect()
    assert [(r["v"], r["n_obs_baresoil"]) for r in kept] == [(None, 1), (0.3, 3)]
    blanked = mask_min_obs(df, 2, keys, mask_n_obs=True).orderBy("col").collect()
    assert [(r["v"], r["n_obs_baresoil"]) for r in blanked] == [(None, None), (0.3, 3)]


PIXELS = "seed_id string, row int, col int, v double, w double, n_obs_baresoil long"


def test_spatial_statistics(spark):
    df = spark.createDataFrame(
        [
            ("a", 0, 0, 0.1, None, 2),
            ("a", 0, 1, 0.3, None, 2),
            ("a", 0, 2, 9.0, 1.0, 1),
            ("b", 0, 0, 0.4, 0.4, 5),
        ],
        PIXELS,
    )
    assert feature_columns(df) == ["v", "w"]
    got = {r["seed_id"]: r for r in seed_statistics(df, 2, (10, 10)).collect()}
    a, b = got["a"], got["b"]
    assert (a["n_pixels"], a["n_pixels_with_min_obs"]) == (3, 2)
    assert a["mean_n_obs_baresoil"] == pytest.approx(5 / 3) and a["median_n_obs_baresoil"] == 2.0
    assert a["v_space_median"] == pytest.approx(0.2) and a["v_space_std"] == pytest.approx(0.1)
    assert a["w_space_median"] is None and a["w_space_mean"] is None and a["w_space_std"] is None
    assert b["v_space_std"] == 0.0 and b["v_space_median"] == 0.4


def test_large_grids_give_the_same_statistics(spark):
    rng = random.Random(3)
    rows = [
        (f"s{k}", i // 40, i % 40, rng.choice([None, rng.random(), 0.5]), rng.gauss(0, 1), rng.randint(1, 5))
        for k in range(4)
        for i in range(0, 1600, k + 1)
    ]
    df = spark.createDataFrame(rows, PIXELS)
    a = seed_statistics(df, 2, (40, 40)).orderBy("seed_id").collect()
    b = seed_statistics(df, 2, spread=True).orderBy("seed_id").collect()
    assert a[0].__fields__ == b[0].__fields__
    for x, y in zip(a, b):
        for name in x.__fields__:
            assert x[name] == (pytest.approx(y[name]) if isinstance(y[name], float) else y[name]), name


def test_coverage(spark):
    df = spark.createDataFrame([("a", 25)], "seed_id string, n_pixels_with_min_obs long")
    assert pixel_coverage(df, (10, 10)).first()["pixel_coverage"] == 0.25


def test_run_end_to_end(spark):
    data = obs(
        spark,
        [
            ("a", 0, 0, 1, 1, 10, BARE),
            ("a", 0, 0, 2, 1, 10, BARE),
            ("a", 0, 1, 1, 1, 10, BARE),
            # the later scene of a day overwrites the earlier, also with vegetation
            ("a", 0, 2, 3, 1, 10, BARE),
            ("a", 0, 2, 3, 2, 10, GREEN),
            # too cloudy, and outside the interval's last day
            ("a", 0, 3, 3, 1, 81, BARE),
            ("green", 0, 0, 1, 1, 10, GREEN),
            ("outside", 10, 0, 1, 1, 10, BARE),
        ],
    )
    run = batch.seed_features(data, seeds(spark, "a", "green", "outside", "absent"), Params(size=(10, 10)))
    got = by_seed(run)
    assert set(got) == {"a", "green"}
    assert (got["a"]["n_pixels"], got["a"]["n_pixels_with_min_obs"]) == (2, 1)
    assert got["a"]["mean_n_obs_baresoil"] == 1.5
    assert got["a"]["B04_median_bs_space_std"] == 0.0
    assert got["green"]["n_pixels"] == 0 and got["green"]["n_pixels_with_min_obs"] == 0
    assert got["green"]["mean_n_obs_baresoil"] is None
    assert got["green"]["NDVI_median_bs_space_mean"] is None
    errors = {r["seed_id"]: r["error"] for r in run.errors.collect()}
    assert errors == {"absent": "no tiles", "outside": "shape mismatch"}
    assert run.features.columns == seed_columns()


def test_rasters_of_any_size_give_full_rows(spark):
    data = obs(spark, [(s, r, c, d, 1, 10, BARE) for s, n in (("a", 11), ("b", 3)) for r in range(n) for c in range(n) for d in (1, 2)])
    run = batch.seed_features(data, seeds(spark, "a", "b"), Params())
    assert {k: r["n_pixels_with_min_obs"] for k, r in by_seed(run).items()} == {"a": 121, "b": 9}
    assert run.errors.isEmpty()


def test_unknown_scene_order_is_an_error(spark):
    data = obs(spark, [("a", 0, 0, 1, None, 10, BARE), ("b", 0, 0, 1, 1, 10, BARE)])
    run = batch.seed_features(data, seeds(spark, "a", "b"), Params())
    assert [(r["seed_id"], r["error"]) for r in run.errors.collect()] == [("a", "scene order missing")]
    assert set(by_seed(run)) == {"b"}


def test_unusable_seeds_are_set_apart(spark):
    data = obs(spark, [(s, 0, 0, 1, 1, 10, BARE) for s in ("a", "nowhere", "twice", "same")])
    listed = seeds(spark, "a", "twice", "same", "same").unionByName(
        spark.createDataFrame([("nowhere", None, 9.0, T0), ("twice", 1.5, 9.0, T0)], SEEDS)
    )
    run = batch.seed_features(data, listed, Params())
    assert set(by_seed(run)) == {"a", "same"} and run.features.count() == 2
    daily = batch.daily_pixels(data, Params())
    assert batch.pixel_timeseries(daily, listed, Params()).filter("seed_id = 'same'").count() == 1
    errors = sorted((r["seed_id"], r["error"]) for r in run.errors.collect())
    assert errors == [
        ("nowhere", "missing coordinates"),
        ("twice", "duplicate seed_id"),
        ("twice", "duplicate seed_id"),
    ]


def test_one_pixel_seed_repeats_its_pixel(spark):
    data = obs(spark, [("a", 0, 0, d, 1, 10, BARE) for d in (1, 2, 3)])
    params = Params()
    px = batch.pixel_features(batch.daily_pixels(data, params), seeds(spark, "a"), params).first()
    seed = by_seed(batch.seed_features(data, seeds(spark, "a"), params))["a"]
    for name in temporal_names():
        assert seed[f"{name}_space_median"] == px[name]
        assert seed[f"{name}_space_std"] == 0.0


def test_column_contracts(spark):
    assert len(pixel_columns()) == 41 and len(timeseries_columns()) == 21 and len(seed_columns()) == 120
    assert pixel_columns()[:7] == ["row", "col", "x", "y", "B02_median_bs", "B02_mean_bs", "B02_std_bs"]
    assert pixel_columns()[-2:] == ["EVI_std_bs", "n_obs_baresoil"]
    params = Params()
    daily = batch.daily_pixels(derived.scene_obs(spark, SF), params)
    points = derived.seeds(spark, SF)
    px = batch.pixel_features(daily, points, params)
    assert px.columns == ["seed_id", "seed_lat", "seed_lon", *pixel_columns()] and len(px.columns) == 44
    assert batch.pixel_timeseries(daily, points, params).columns == timeseries_columns()


def test_row_order_and_partitions_do_not_matter(spark):
    base, points = derived.scene_obs(spark, SF), derived.seeds(spark, SF)
    params = Params()
    want = batch.seed_features(base, points, params).features.orderBy("seed_id").collect()
    mixed = base.repartition(13, F.rand(1))
    got = batch.seed_features(mixed, points, params).features.orderBy("seed_id").collect()
    assert len(want) == len(got) > 0
    for x, y in zip(want, got):
        for name in x.__fields__:
            assert y[name] == (pytest.approx(x[name]) if isinstance(x[name], float) else x[name])


def test_higher_threshold_never_lowers_counts(spark):
    points = derived.seeds(spark, SF)
    totals = []
    for threshold in (-0.5, 0.0, 0.2, 0.9):
        params = Params(ndvi_threshold=threshold)
        daily = batch.daily_pixels(derived.scene_obs(spark, SF), params)
        totals.append(batch.pixel_stats(daily, params).agg(F.sum("n_obs_baresoil")).first()[0] or 0)
    assert totals == sorted(totals) and totals[0] < totals[-1]
    assert points.count() > 0


def test_single_seed_run_equals_batch(spark):
    data, points = derived.scene_obs(spark, SF), derived.seeds(spark, SF)
    seed = points.orderBy("seed_id").first()
    one = batch.run_one_seed(data, seed["seed_id"], seed["lat"], seed["lon"], seed["transform"], Params())
    whole = batch.seed_features(data, points, Params())
    want = whole.features.filter(F.col("seed_id") == seed["seed_id"]).first()
    got = one.features.first()
    for name in got.__fields__:
        assert got[name] == (pytest.approx(want[name]) if isinstance(want[name], float) else want[name])


def test_single_point_layouts(spark):
    from fallowlens.plans import single_point as sp

    data = obs(
        spark,
        [("a", 0, 0, 1, 1, 10, BARE), ("a", 0, 0, 2, 1, 10, BARE), ("a", 0, 1, 1, 1, 10, BARE)],
    )
    params = Params(size=(2, 1))
    run = sp.aggregate_point(batch.daily_pixels(data, params), seeds(spark, "a"), params)
    assert len(run.series.columns) == 17 and run.series.count() == 3
    assert run.pixels.columns == pixel_columns()
    assert [r["n_obs_baresoil"] for r in run.pixels.orderBy("col").collect()] == [2, None]
    grids = {r["band"]: r["grid"] for r in run.composite.collect()}
    assert grids["B04"] == [[pytest.approx(0.10), 0.0]]
    assert run.maps.first()["n_obs"] == [[2, 0]]
    row = sp.point_row(batch.seed_features(data, seeds(spark, "a"), params).features, params)
    assert row.columns[:6] == ["lat", "lon", "window_m", "start_date", "end_date", "min_obs_baresoil"]
    assert len(row.columns) == 118 and row.first()["n_pixels"] == 2
