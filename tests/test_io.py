import pytest
from pyspark.sql import functions as F

from fallowlens.operators import grids, scenes
from fallowlens.plans import batch
from fallowlens.plans.seeds import prepare_seeds
from fallowlens.schemas import Params, pixel_columns, seed_columns, timeseries_columns
from fallowlens.session import materialize
from fallowlens.sources import derived, sinks
from fallowlens.sources.tables import read_csv_inferred, read_results, read_survey
from fallowlens.streaming import runs

SF = "/root/testdata/sf0.001"


def test_stored_run_equals_the_lazy_plan(spark, tmp_path):
    obs = derived.scene_obs(spark, SF)
    seeds = derived.seeds(spark, SF)
    absent = seeds.limit(1).withColumn("seed_id", F.lit("absent"))
    seeds = seeds.unionByName(absent)
    params, out = Params(), str(tmp_path)
    assert batch.run_batch(obs, seeds, params, out) == {"features": True, "errors": True}
    series = runs.published(spark, out, "pixel_timeseries")
    assert series.columns == timeseries_columns() + ["window", "start_date", "end_date"]
    px = runs.published(spark, out, "pixel_features")
    assert px.columns == ["seed_id", "seed_lat", "seed_lon", *pixel_columns(), "window", "start_date", "end_date"]
    stored = runs.published(spark, out, "seed_features").orderBy("seed_id")
    assert stored.columns == seed_columns()
    want = batch.seed_features(obs, seeds, params).features.orderBy("seed_id").collect()
    got = stored.collect()
    assert len(got) == len(want) > 0
    for x, y in zip(want, got):
        for name in x.__fields__:
            assert y[name] == (pytest.approx(x[name]) if isinstance(x[name], float) else x[name]), name
    errors = spark.read.option("header", True).csv(f"{out}/errors").collect()
    assert [(r["seed_id"], r["error"]) for r in errors] == [("absent", "no tiles")]


def test_runs_stand_beside_each_other(spark, tmp_path):
    obs, seeds, out = derived.scene_obs(spark, SF), derived.seeds(spark, SF), str(tmp_path)
    first, second = Params(end_date="2024-06-10"), Params(start_date="2024-06-11")
    wider = Params(end_date="2024-06-10", window_m=200.0)
    counts = {}
    for params in (first, second, wider, first):
        batch.run_batch(obs, seeds, params, out)
        for name in ("pixel_timeseries", "pixel_features"):
            counts[params, name] = sinks.of_run(runs.published(spark, out, name), params).count()
    for name in ("pixel_timeseries", "pixel_features"):
        assert runs.published(spark, out, name).count() == sum(n for (_, k), n in counts.items() if k == name)
    assert counts[first, "pixel_features"] == counts[wider, "pixel_features"] > 0


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    from fallowlens.sources.tables import read_seeds, with_seed_ids

    for name, n in (("a", 2), ("b", 3000), ("c", 5)):
        lines = [f"{1 + k / 1e4},{ord(name)}" for k in range(n)]
        (tmp_path / f"{name}.csv").write_text("lat,lon\n" + "\n".join(lines) + "\n")
    got = [(r["lon"], r["lat"]) for r in read_seeds(spark, str(tmp_path), has_id=False).orderBy(F.expr("cast(substr(seed_id, 6) as int)")).collect()]
    assert got == sorted(got) and len(got) == 3007
    seq = read_survey(spark, str(tmp_path), spark.read.option("header", True).csv(str(tmp_path)).schema)
    assert sorted(r["seq"] for r in seq.collect()) == list(range(3007)) and with_seed_ids is not None


def test_nothing_is_written_for_empty_results(spark, tmp_path):
    empty = spark.createDataFrame([], "seed_id string, error string")
    assert not sinks.write_errors(empty, str(tmp_path / "e"))
    assert not sinks.write_seed_features(empty, str(tmp_path / "f"))
    assert not list(tmp_path.iterdir())


def test_survey_tiles_grids_and_mosaics_round_trip(spark, tmp_path):
    survey = prepare_seeds(derived.survey_values(spark, SF), derived.survey_coords(spark, SF))
    sinks.write_survey(survey, str(tmp_path / "c"), str(tmp_path / "p"))
    back = read_survey(spark, str(tmp_path / "c"), spark.read.parquet(str(tmp_path / "p")).schema)
    assert back.count() == survey.count()
    assert back.agg(F.sum("lat")).first()[0] == pytest.approx(survey.agg(F.sum("lat")).first()[0])
    assert dict(read_csv_inferred(spark, str(tmp_path / "c")).dtypes)["OC"] == "double"

    tiles = derived.tiles(spark, SF)
    sinks.write_tiles(tiles, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == tiles.count() and set(stored.columns) == set(tiles.columns)

    daily = batch.daily_pixels(derived.scene_obs(spark, SF), Params())
    px = batch.pixel_features(daily, derived.seeds(spark, SF), Params())
    sinks.write_table(px, str(tmp_path / "px"))
    sinks.write_table(grids.qa_grids(spark.read.parquet(str(tmp_path / "px")), (10, 10)), str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g")).count() == px.select("seed_id").distinct().count()

    mosaic = scenes.median_mosaic(derived.scene_obs(spark, SF), ["B04"])
    sinks.write_mosaic(mosaic, str(tmp_path / "m"), "s2", "field", "june")
    assert spark.read.parquet(str(tmp_path / "m")).filter("aoi = 'field'").count() == mosaic.count()


def test_materialize_uses_the_named_folder(spark):
    df = materialize(spark.range(5).withColumn("v", F.col("id") * 2))
    assert df.agg(F.sum("v")).first()[0] == 20
    assert spark.sparkContext.getCheckpointDir() is not None
