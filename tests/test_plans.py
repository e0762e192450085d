"""Plan shape: what is read, pushed down and shuffled."""

import re
from dataclasses import replace

import pytest

from fallowlens.operators import scenes
from fallowlens.operators.windows import window_join
from fallowlens.plans import batch
from fallowlens.schemas import Params
from fallowlens.sources import derived

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("obs") / "obs")
    derived.placed_obs(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_bands_reach_the_scan(stored):
    df = scenes.select_scenes(stored, "2024-06-05", "2024-06-20", 20, ["B04"], (0, 0, 1e6, 1e7))
    text = plan(df)
    pushed = re.search(r"PushedFilters: \[([^]]*)", text).group(1)
    for column in ("acq_date", "cloud_cover", "x", "y"):
        assert column in pushed
    assert "B12" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_feature_plan_shuffles_three_times(stored):
    params = Params()
    pixels = batch.pixel_stats(batch.daily_pixels(stored, params), params)
    assert plan(pixels).count("Exchange hashpartitioning") == 2
    # same-day overwrite stays in fixed-width hash buffers and combines on the map side
    text = plan(batch.daily_pixels(stored, params))
    assert "SortAggregate" not in text and "partial_max_by" in text
    assert text.count("Exchange") == 1
    from fallowlens.operators.spatial import seed_statistics

    seeds = seed_statistics(pixels, params.min_obs, params.size)
    assert plan(seeds).count("Exchange hashpartitioning") == 3


def test_whole_plans_scan_the_observations_once_or_twice(spark, stored):
    from fallowlens.plans.training import training_table

    seeds = derived.seeds(spark, SF)
    run = batch.seed_features(stored, seeds, Params())
    scans = lambda df: len(re.findall(r"Scan parquet[^\n]*B08|Scan parquet[^\n]*scene_idx", plan(df)))
    assert scans(run.features) == 2 and scans(run.errors) == 1
    survey = seeds.select("seed_id", "lat", "lon")
    assert scans(training_table(run.features, survey)) == 2


def test_row_local_operators_do_not_shuffle(spark, stored):
    from fallowlens.operators import tiles as t
    from fallowlens.schemas import BANDS, STACKED_TILES

    assert "Exchange" not in plan(scenes.resample_nearest(stored, 20.0, 10.0, (20, 20)))
    stacks = spark.createDataFrame([], STACKED_TILES)
    assert "Exchange" not in plan(t.explode_pixels(t.unstack_dates(stacks, BANDS), BANDS))


def test_range_join_is_an_equi_join(spark, stored):
    windows = spark.createDataFrame([], "seed_id string, minx double, miny double, maxx double, maxy double")
    text = plan(window_join(stored, windows, 100.0))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_stored_flag_filters_at_the_scan(spark, tmp_path):
    params = Params()
    daily = batch.daily_pixels(derived.scene_obs(spark, SF), params)
    batch.pixel_timeseries(daily, derived.seeds(spark, SF), params).write.parquet(str(tmp_path / "ts"))
    text = plan(batch.pixel_stats(spark.read.parquet(str(tmp_path / "ts")), params))
    assert "is_baresoil" in re.search(r"PushedFilters: \[([^]]*)", text).group(1)
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "EVI" not in schema and "seed_lat" not in schema


def test_spread_reaches_the_seed_plan(spark, stored):
    params, seeds = Params(ndvi_threshold=0.2), derived.seeds(spark, SF)
    gathered = batch.seed_features(stored, seeds, params).features
    spread = batch.seed_features(stored, seeds, replace(params, spread=True)).features
    assert "_px#" in plan(gathered) and "_px#" not in plan(spread)
    rows = {r["seed_id"]: r for r in spread.collect()}
    found = gathered.collect()
    assert found and len(found) == len(rows)
    for r in found:
        for name in r.__fields__:
            other = rows[r["seed_id"]][name]
            assert r[name] == (pytest.approx(other) if isinstance(other, float) else other), name
