import random

import pytest
from pyspark.sql import functions as F

from fallowlens.functions import geo
from fallowlens.functions.naming import mosaic_name, point_name
from fallowlens.operators.windows import window_join
from fallowlens.plans import batch, points
from fallowlens.schemas import Params
from fallowlens.sources.tables import number_rows, read_seeds, with_seed_ids
from fallowlens.streaming.incremental import merge_runs, skip_done, with_work_key


def test_projection_goldens(spark):
    df = spark.createDataFrame([(45.0, 9.0), (44.8915307, 10.01263632)], "lat double, lon double")
    got = geo.window_around(df, 100.0).collect()
    centres = [((r["minx"] + r["maxx"]) / 2, (r["miny"] + r["maxy"]) / 2) for r in got]
    assert centres[0] == (pytest.approx(500000.0, abs=1e-3), pytest.approx(4982950.4002, abs=1e-3))
    assert centres[1] == (pytest.approx(579961.6971, abs=1e-3), pytest.approx(4971399.6824, abs=1e-3))
    for r in got:
        assert r["maxx"] - r["minx"] == pytest.approx(100.0, abs=1e-8) and r["epsg"] == 32632


def test_southern_zone_and_passthrough(spark):
    df = spark.createDataFrame([(45.0, 9.0), (-45.0, 9.0)], "lat double, lon double")
    north = geo.window_around(df, 0.0, 32632).collect()
    south = geo.window_around(df, 0.0, 32732).collect()
    assert south[0]["miny"] - north[0]["miny"] == pytest.approx(1e7)
    assert south[1]["miny"] == pytest.approx(1e7 - north[0]["miny"])
    same = geo.window_around(df, 2.0, 4326, 4326).first()
    assert (same["minx"], same["maxy"]) == (8.0, 46.0)
    with pytest.raises(ValueError):
        geo.window_around(df, 2.0, 3035)


def test_window_join_equals_brute_force(spark):
    rng = random.Random(2)
    # half of the points fall on the lattice the window edges lie on
    points = [(i, rng.choice([rng.uniform(-50, 250), 10.0 * rng.randrange(-5, 25)]), 10.0 * rng.randrange(-5, 25)) for i in range(400)]
    windows = [(f"s{k}", x, y, x + 40.0, y + 40.0) for k in range(25) for x, y in [(10.0 * rng.randrange(20), 10.0 * rng.randrange(20))]]
    windows += [("twin", *windows[0][1:])]
    obs = spark.createDataFrame(points, "i int, x double, y double")
    win = spark.createDataFrame(windows, "seed_id string, minx double, miny double, maxx double, maxy double")
    want = sorted((s, i) for i, x, y in points for s, a, b, c, d in windows if a <= x < c and b <= y < d)
    for cell in (40.0, 13.0, 500.0):
        assert sorted((r["seed_id"], r["i"]) for r in window_join(obs, win, cell).collect()) == want


def test_names(spark):
    df = spark.createDataFrame([(44.8915307, 10.01263632), (None, 1.0)], "lat double, lon double")
    names = [r[0] for r in df.select(point_name(F.col("lat"), F.col("lon"))).collect()]
    assert names == ["point_44p891531_10p012636", None]
    one = spark.range(1).select(
        mosaic_name(
            F.lit("s2"), F.lit("2024-06-01"), F.lit("2024-06-30"),
            F.array(F.lit("B02"), F.lit("B03")), F.lit(512), F.lit(256), F.lit("ndvi"),
        ).alias("a"),
        mosaic_name(F.lit("s2"), F.lit("2024-06-01"), F.lit("2024-06-30"), None, F.lit(0), F.lit(5)).alias("b"),
    ).first()
    assert tuple(one) == ("s2_2024-06-01_2024-06-30_B02-B03_512x256_ndvi", "s2_2024-06-01_2024-06-30")


def test_finished_points_are_skipped(spark):
    seeds = spark.createDataFrame(
        [("a", 45.0, 9.0), ("twin", 45.0, 9.0), ("b", 46.0, 9.0), ("c", 47.0, 9.0)], "seed_id string, lat double, lon double"
    )
    marked = with_work_key(seeds, Params()).withColumns(
        {
            "n_tiles": F.when(F.col("seed_id") == "c", 0).otherwise(3),
            "bands": F.when(F.col("seed_id") != "b", F.lit("B02")),
        }
    )
    manifest = marked.filter("seed_id != 'twin'")
    assert sorted(r["seed_id"] for r in skip_done(seeds, manifest, Params()).collect()) == ["b", "c"]
    assert skip_done(seeds, manifest, Params(end_date="2024-07-31")).count() == 4
    # the key does not depend on bands, cloud cover or threshold
    assert skip_done(seeds, manifest, Params(max_cloud=5, ndvi_threshold=0.1)).count() == 2
    runs = merge_runs(seeds, seeds.select("seed_id"))
    assert runs.count() == 8 and runs.columns == seeds.columns


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"{part}.csv").write_text("lon,lat\n" + "".join(f"9.0,{part * 100 + i}\n" for i in range(40)))
    parts = spark.read.schema("lon double, lat double").option("header", True).csv(str(tmp_path))
    got = {r["lat"]: r["position"] for r in number_rows(parts).collect()}
    assert sorted(got.values()) == list(range(120))
    for part in range(3):
        inside = [got[part * 100.0 + i] for i in range(40)]
        assert inside == list(range(inside[0], inside[0] + 40))


def test_seed_tables(spark, tmp_path):
    (tmp_path / "named.csv").write_text("lat,lon,seed_id\n45.5,9.5,0012\n")
    (tmp_path / "plain.csv").write_text("name,lon,lat\nx,9.5,45.5\ny,9.6,45.6\n")
    assert tuple(read_seeds(spark, str(tmp_path / "named.csv")).first()) == ("0012", 45.5, 9.5)
    plain = read_seeds(spark, str(tmp_path / "plain.csv")).orderBy("seed_id").collect()
    assert [tuple(r) for r in plain] == [("seed_0000", 45.5, 9.5), ("seed_0001", 45.6, 9.6)]
    with pytest.raises(ValueError, match="lon"):
        with_seed_ids(spark.createDataFrame([(1.0,)], "lat double"))


def test_only_files_of_the_interval_are_opened(spark, tmp_path):
    from fallowlens.sources.rasters import read_rasters

    names = ["2024-05-31", "2024-06-01", "2024-06-30", "2024-07-01", "2023-06-15", "2024-06-31", "nodate"]
    for n in names:
        (tmp_path / f"{n}.tif").write_bytes(n.encode())
    found = {"width": 1, "height": 1, "transform": [1.0] * 6, "bands": ["B04"], "data": [1.0]}
    rasters = read_rasters(spark, str(tmp_path), lambda raw: {**found, "epsg": 32632}, start="2024-06-01", end="2024-06-30")
    assert sorted(str(r["date"]) for r in rasters.collect()) == ["2024-06-01", "2024-06-30", "None", "None"]
    scan = rasters._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 4
    assert {r["epsg"] for r in rasters.collect()} == {32632}
    every = read_rasters(spark, str(tmp_path), lambda raw: found)
    assert every.count() == len(names) and every.filter("epsg is not null").isEmpty()


def test_windows_in_zones_and_resolutions(spark):
    from fallowlens.functions import geo
    from fallowlens.plans.points import on_one_grid
    from fallowlens.schemas import BANDS

    points = spark.createDataFrame(
        [("a", 45.0, 9.0), ("border", 45.0, 11.99), ("south", -33.0, 18.0), ("west", 10.0, -179.5)], "seed_id string, lat double, lon double"
    )
    zones = [32632, 32633, 32634, 32660, 32601, 32734]
    got = {}
    for r in geo.windows_in_zones(points, 100.0, zones).collect():
        got.setdefault(r["seed_id"], set()).add(r["epsg"])
        assert r["maxx"] - r["minx"] == pytest.approx(100) and r["maxy"] - r["miny"] == pytest.approx(100)
    assert got == {"a": {32632, 32633}, "border": {32632, 32633}, "south": {32734}, "west": {32660, 32601}}
    one = geo.window_around(points, 100.0, 32633).filter("seed_id = 'a'").first()
    same = geo.windows_in_zones(points, 100.0, [32633]).filter("seed_id = 'a'").first()
    assert tuple(one) == tuple(same)

    window = spark.createDataFrame([("a", 45.0, 9.0, 0.0, 0.0, 40.0, 40.0)], "seed_id string, lat double, lon double, minx double, miny double, maxx double, maxy double")
    when = ["date'2024-06-02' as acq_date", "1 as scene_idx", "3 as cloud_cover"]
    fine = spark.range(16).selectExpr("5 + 10D * (id % 4) as x", "35 - 10D * (id div 4) as y", *when, *(f"id + 0D as {b}" for b in BANDS[:4]))
    coarse = spark.range(4).selectExpr("10 + 20D * (id % 2) as x", "30 - 20D * (id div 2) as y", *when, *(f"100D + id as {b}" for b in BANDS[4:]))
    rows = on_one_grid({10.0: fine, 20.0: coarse.filter("x < 20")}, window, Params()).collect()
    assert len(rows) == 16
    for r in rows:
        assert r["B02"] == 4 * r["row"] + r["col"]
        assert r["B11"] == (100 + 2 * (r["row"] // 2) if r["col"] < 2 else None)
    with pytest.raises(ValueError, match="one resolution"):
        on_one_grid({10.0: fine}, window, Params())


def test_pixels_are_gridded_without_a_second_join_with_the_windows(spark):
    scenes = spark.createDataFrame([(5.0, 15.0, 0.25), (15.0, 5.0, 0.5), (25.0, 5.0, 0.75)], "x double, y double, B04 double")
    windows = spark.createDataFrame([("a", 0.0, 0.0, 20.0, 20.0), (None, 0.0, 0.0, 20.0, 20.0)], "seed_id string, minx double, miny double, maxx double, maxy double")
    cut = points._cut(scenes, windows, 20.0, 10.0, 10.0)
    assert cut.columns == ["seed_id", "B04", "row", "col"]
    assert sorted(tuple(r) for r in cut.collect()) == [("a", 0.25, 0, 0), ("a", 0.5, 1, 1)]
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def _two_resolutions(spark, tmp_path):
    """Stored sources over misaligned windows: several scenes a day, NaN, bright and unnumbered seeds."""
    from fallowlens.schemas import BANDS

    draw = random.Random(7)
    windows = [(s, 45.0, 9.0, x, 3.0, x + 40.0, 43.0) for s, x in (("a", 2.0), ("bright", 1002.0), ("c", 2007.0), ("unnumbered", 3002.0), ("none", 9000.0))]
    rows = {10: [], 20: []}
    for s, _, _, x, *_ in windows[:4]:
        for res, bands in ((10, BANDS[:4]), (20, BANDS[4:])):
            for _ in range(600):
                at = [res * (draw.randrange(-20 // res, 60 // res) + 0.5) for _ in range(2)]
                scene = (f"2024-06-0{draw.randrange(1, 6)}", draw.randrange(1, 4), 3 if draw.random() < 0.9 else 99)
                values = {b: draw.choice([0.1, 0.2, 0.3, float("nan")]) for b in bands}
                if s == "bright" and res == 10:
                    values |= {"B04": 0.1, "B08": 0.9}
                if s == "unnumbered" and draw.random() < 0.01:
                    scene = (scene[0], None, 3)
                rows[res].append((1000.0 * (x // 1000) + at[0], at[1], *scene, *values.values()))
    kinds = "x double, y double, acq_date string, scene_idx long, cloud_cover int, "
    sources = {}
    for res, bands in ((10, BANDS[:4]), (20, BANDS[4:])):
        frame = spark.createDataFrame(rows[res], kinds + ", ".join(f"{b} double" for b in bands))
        frame = frame.groupBy("x", "y", "acq_date", "scene_idx").agg(F.max("cloud_cover").alias("cloud_cover"), *[F.max(b).alias(b) for b in bands])
        frame.withColumn("acq_date", F.col("acq_date").cast("date")).write.parquet(str(tmp_path / f"{res}"))
        sources[float(res)] = spark.read.parquet(str(tmp_path / f"{res}"))
    edges = "seed_id string, lat double, lon double, minx double, miny double, maxx double, maxy double"
    return sources, spark.createDataFrame(windows, edges)


def test_resolutions_read_their_sources_once_for_the_features(spark, tmp_path):
    sources, windows = _two_resolutions(spark, tmp_path)
    features = points.features_from_resolutions(sources, windows, Params()).features
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2
    # pixels move once after their join with the windows: listed, met and reduced where their seed is
    assert plan.count("REPARTITION_BY") == 1
    joined = plan[: plan.index("REPARTITION_BY")]
    assert joined.count("Generate explode") == 2 and "max_by" in joined
    between = joined[joined.rindex("collect_list"):]
    assert "Exchange hashpartitioning" not in between[: between.rindex("Exchange")]


@pytest.mark.parametrize("spread", [False, True])
def test_resolutions_give_the_features_of_the_plain_plan(spark, tmp_path, spread):
    sources, windows = _two_resolutions(spark, tmp_path)
    params = Params(spread=spread, size=(4, 4))
    run = points.features_from_resolutions(sources, windows, params)
    grid = points.on_one_grid(sources, windows, params)
    plain = batch.seed_features(grid, points._with_transform(windows, 10.0), Params(size=(4, 4)))
    wanted = {r["seed_id"]: r for r in plain.features.collect()}
    got = {r["seed_id"]: r for r in run.features.collect()}
    assert set(got) == set(wanted) == {"a", "bright", "c"}
    assert got["bright"]["n_pixels"] == 0 and got["a"]["n_pixels_with_min_obs"] > 0
    for seed, r in wanted.items():
        for name in r.__fields__:
            assert got[seed][name] == (pytest.approx(r[name]) if isinstance(r[name], float) else r[name]), (seed, name)
    found = sorted((r["seed_id"], r["error"]) for r in run.errors.collect())
    assert found == sorted((r["seed_id"], r["error"]) for r in plain.errors.collect())
    assert found == [("none", "no tiles"), ("unnumbered", "scene order missing")]
    assert {r["seed_id"] for r in run.processed.collect()} == set(wanted)
