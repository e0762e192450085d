import datetime as dt
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.indices import ndvi
from fallowlens.operators import grids
from fallowlens.operators import tiles as t
from fallowlens.operators.scenes import last_of_day
from fallowlens.schemas import BANDS, STACKED_TILES, TILES
from fallowlens.sources import derived
from fallowlens.sources.rasters import attach_seeds, discover, first_file, read_rasters

T0 = [10.0, 0.0, 500000.0, 0.0, -10.0, 4970000.0]


def userdata(*stamps):
    return json.dumps({"acquisition_dates": json.dumps(list(stamps))})


def stack(spark, stamps, data, width=2, height=1, seed="a"):
    return spark.createDataFrame([(seed, userdata(*stamps), width, height, T0, data)], STACKED_TILES)


def tile(spark, rows):
    return spark.createDataFrame(rows, TILES)


def test_unstacking_cuts_dates_and_keeps_the_last_of_a_day(spark):
    data = [float(v) for v in range(12)]  # 3 acquisitions x 2 bands x 2 pixels
    stamps = ["2024-06-01T10:00:00Z", "2024-06-04T10:00:00Z", "2024-06-01T12:00:00Z"]
    got = t.unstack_dates(stack(spark, stamps, data), ["B04", "B08"]).orderBy("date").collect()
    assert [(r["date"], r["data"]) for r in got] == [
        (dt.date(2024, 6, 1), [8.0, 9.0, 10.0, 11.0]),
        (dt.date(2024, 6, 4), [4.0, 5.0, 6.0, 7.0]),
    ]
    assert got[0]["bands"] == ["B04", "B08"]


def test_stack_with_a_wrong_band_count_is_left_out(spark):
    short = stack(spark, ["2024-06-01T10:00:00Z"], [1.0, 2.0, 3.0])
    assert t.unstack_dates(short, ["B04", "B08"]).count() == 0


def test_explode_places_pixels_and_reads_bands_by_position(spark):
    data = [float(v) for v in range(12)]  # 2 bands x 2 rows x 3 columns
    df = tile(spark, [("a", dt.date(2024, 6, 1), 3, 2, T0, ["B04", "B08"], data)])
    got = t.explode_pixels(df, ["B04", "B08"]).orderBy("row", "col").collect()
    assert [(r["row"], r["col"], r["B04"], r["B08"]) for r in got] == [
        (i // 3, i % 3, float(i), float(i + 6)) for i in range(6)
    ]
    assert (got[5]["x"], got[5]["y"]) == (500025.0, 4969985.0)
    prefix = t.explode_pixels(df, ["first"])
    assert prefix.columns == ["seed_id", "date", "row", "col", "x", "y", "first"]
    assert prefix.count() == 6


def test_explode_by_name_and_missing_values(spark):
    nan = float("nan")
    df = tile(spark, [("a", dt.date(2024, 6, 1), 2, 1, T0, ["B08", "B04"], [0.5, nan, 0.25, 0.125])])
    got = t.explode_pixels(df, ["B04", "B08", "B11"], by_name=True).orderBy("col").collect()
    assert [(r["B04"], r["B08"], r["B11"]) for r in got] == [(0.25, 0.5, None), (0.125, None, None)]


def test_tile_level_overwrite_and_first_geometry(spark):
    other = [10.0, 0.0, 7.0, 0.0, -10.0, 9.0]
    rows = [
        ("a", dt.date(2024, 6, 2), 1, 1, other, ["B04"], [1.0]),
        ("a", dt.date(2024, 6, 1), 1, 1, T0, ["B04"], [2.0]),
    ]
    placed = t.with_first_transform(tile(spark, rows))
    assert {tuple(r["transform"]) for r in placed.collect()} == {tuple(T0)}
    scenes = tile(spark, rows + rows[:1]).withColumn("scene_idx", F.monotonically_increasing_id())
    assert t.last_of_day_tiles(scenes).count() == 2


def test_centre_pixel_extremes_and_dimensions(spark):
    data = [float(v) for v in range(24)]  # 2 bands x 3 rows x 4 columns
    df = tile(spark, [("a", dt.date(2024, 6, 1), 4, 3, T0, ["B04", "B08"], data)])
    row = t.centre_pixel(df, ["B04", "B08"]).first()
    assert (row["row"], row["col"], row["B04"], row["B08"]) == (1, 2, 6.0, 18.0)
    assert tuple(t.raster_min_max(df).first()) == (0.0, 23.0)
    dims = t.stack_dimensions(df).first()
    assert (dims["n_dates"], dims["n_bands"], dims["height"], dims["width"]) == (1, 2, 3, 4)


def test_metadata_documents(spark):
    df = spark.createDataFrame([('{"bands": ["B04", "B08"]}',), ("broken",)], "j string")
    assert [r[0] for r in df.select(t.band_order(F.col("j"))).collect()] == [["B04", "B08"], None]
    none = stack(spark, [], [1.0]).withColumn("userdata", F.lit("{}"))
    assert t.with_dates(none).first()["dates"] is None


def test_files_are_found_dated_and_decoded(spark, tmp_path):
    def decode(content):
        """Test format: width, height, bands as 32-bit numbers, then 32-bit floats."""
        width, height, n = struct.unpack("<3i", content[:12])
        values = struct.unpack(f"<{width * height * n}f", content[12:])
        return {
            "width": width,
            "height": height,
            "transform": T0,
            "bands": ["B04", "B08"][:n],
            "data": list(values),
        }

    (tmp_path / "deep").mkdir()
    body = struct.pack("<3i4f", 2, 1, 2, 0.5, 0.25, 1.0, 2.0)
    for name in ("deep/2024-06-02.tif", "2024-06-01.tif", "other.tif", "notes.txt"):
        (tmp_path / name).write_bytes(body)
    files = discover(spark, str(tmp_path))
    point = tmp_path / "point_45p500000_9p250000" / "per_date"
    point.mkdir(parents=True)
    (point / "2024-06-03.tif").write_bytes(body)
    seeds = spark.createDataFrame(
        [("a", 45.5, 9.25), ("twin", 45.5, 9.25), ("b", 1.0, 2.0)], "seed_id string, lat double, lon double"
    )
    owned = attach_seeds(read_rasters(spark, str(point.parent), decode), seeds)
    assert sorted(r["seed_id"] for r in owned.collect()) == ["a", "twin"]
    (point / "2024-06-03.tif").unlink()
    assert sorted(str(r["date"]) for r in files.collect()) == ["2024-06-01", "2024-06-02", "None"]
    assert first_file(files).first()["path"].endswith("/2024-06-01.tif")
    tiles = read_rasters(spark, str(tmp_path), decode)
    px = t.explode_pixels(tiles.filter(F.col("date") == "2024-06-02"), ["B04", "B08"]).orderBy("col")
    assert [(r["B04"], r["B08"]) for r in px.collect()] == [(0.5, 1.0), (0.25, 2.0)]


PX = "seed_id string, row int, col int, B04_median_bs double, NDVI_median_bs double, NDMI_median_bs double, n_obs_baresoil long"


def test_grids_fill_gaps(spark):
    df = spark.createDataFrame(
        [("a", 0, 1, 0.5, 0.1, 0.2, 3), ("a", 1, 0, None, None, None, 1)], PX
    )
    points = spark.createDataFrame([("a",), ("b",)], "seed_id string")
    comp = {r["seed_id"]: r for r in grids.composite_grids(df, (2, 3), ["B04"], points).collect()}
    assert comp["a"]["band"] == "B04"
    assert comp["a"]["grid"] == [[0.0, 0.5], [0.0, 0.0], [0.0, 0.0]]
    assert comp["b"]["grid"] == [[0.0, 0.0]] * 3
    qa = grids.qa_grids(df, (2, 3)).collect()
    assert len(qa) == 1 and qa[0]["n_obs"] == [[0, 3], [1, 0], [0, 0]]
    assert qa[0]["ndvi"][0] == [None, pytest.approx(0.1)] and qa[0]["ndvi"][1] == [None, None]
    assert grids.grid_cells(grids.qa_grids(df, (2, 3)), ["n_obs"]).count() == 6
    # a seed with a pixel outside its grid is set apart; the others get theirs
    assert [r["seed_id"] for r in grids.qa_grids(df, (1, 3), points).collect()] == ["b"]
    assert [r["seed_id"] for r in grids.grid_faults(df, (1, 3), points).collect()] == ["a"]
    assert grids.grid_faults(df, (2, 3), points).isEmpty()
    # without a declared size a grid is as large as its seed's raster, or its pixels
    assert grids.qa_grids(df).first()["n_obs"] == [[0, 3], [1, 0]]
    shapes = spark.createDataFrame([("a", 3, 2), ("b", 1, 1)], "seed_id string, width int, height int")
    own = {r["seed_id"]: r["n_obs"] for r in grids.qa_grids(df, seeds=shapes).collect()}
    assert own == {"a": [[0, 3, 0], [1, 0, 0]], "b": [[0]]}


def test_stamps_files_and_bands_that_fail_are_set_apart(spark, tmp_path):
    from fallowlens.plans import stacks
    from fallowlens.plans import tiles as plan
    from fallowlens.schemas import BANDS, Params
    from fallowlens.sources.rasters import attach_seeds, discover, read_rasters

    bare = (0.05, 0.07, 0.10, 0.14, 0.25, 0.20)
    stamped = lambda s, *days: (s, '{"acquisition_dates": "[' + ", ".join(f'\\"{d}\\"' for d in days) + ']"}')
    rows = [(*stamped(s, *days), 1, 1, T0, [v for _ in days for v in bare]) for s, *days in (
        ("a", "2024-06-01", "2024-06-02"), ("bad", "garbage", "2024-06-02"), ("late", "2024-07-01"))]
    stacked = spark.createDataFrame(rows, "seed_id string, userdata string, width int, height int, transform array<double>, data array<float>")
    seeds = spark.createDataFrame([(s, 45.0, 9.0) for s in ("a", "bad", "late")], "seed_id string, lat double, lon double")
    run = stacks.seed_features(stacked, seeds, Params(min_obs=1))
    assert {r["seed_id"]: r["error"] for r in run.errors.collect()} == {"bad": "acquisition dates missing", "late": "no tiles"}
    assert [(r["seed_id"], r["n_pixels"]) for r in run.features.collect()] == [("a", 1)]

    points = spark.createDataFrame([("ok", 1.0, 2.0), ("corrupt", 3.0, 4.0), ("undated", 5.0, 6.0), ("poor", 7.0, 8.0)], "seed_id string, lat double, lon double")
    for lat, lon, name, content in ((1, 2, "2024-06-01", "ok"), (3, 4, "2024-06-01", "x"), (5, 6, "2024-13-45", "ok"), (7, 8, "2024-06-01", "poor")):
        folder = tmp_path / f"point_{lat}p000000_{lon}p000000"
        folder.mkdir()
        (folder / f"{name}.tif").write_text(content)

    def decoder(content):
        names = {b"ok": list(BANDS), b"poor": list(BANDS[:3])}[content]
        return {"width": 1, "height": 1, "transform": T0, "bands": names, "data": list(bare[: len(names)])}

    assert discover(spark, str(tmp_path)).filter("date is null").count() == 1
    tiles = attach_seeds(read_rasters(spark, str(tmp_path), decoder), points)
    run = plan.seed_features(tiles, points, Params(min_obs=1))
    assert {r["seed_id"]: r["error"] for r in run.errors.collect()} == {
        "corrupt": "corrupt raster", "undated": "corrupt raster", "poor": "bands missing"}
    assert [(r["seed_id"], r["n_pixels"]) for r in run.features.collect()] == [("ok", 1)]


def test_stack_plan_reports_and_agrees_with_exploded_pixels(spark):
    from fallowlens.plans import stacks
    from fallowlens.schemas import Params
    from fallowlens.sources import derived

    sf = "/root/testdata/sf0.001"
    stored = derived.stacked_tiles(spark, sf)
    twin = stored.filter(F.col("seed_id") == "seed_0001")
    bad = stored.withColumn("data", F.when(F.col("seed_id") == "seed_0002", F.slice("data", 1, 7)).otherwise(F.col("data")))
    given = bad.unionByName(twin)
    params = Params(ndvi_threshold=-0.5)
    run = stacks.seed_features(given, derived.seeds(spark, sf), params)
    errors = {r["seed_id"]: r["error"] for r in run.errors.collect()}
    assert errors == {"seed_0001": "duplicate stack", "seed_0002": "band count mismatch"}
    rows = {r["seed_id"]: r for r in run.features.collect()}
    assert len(rows) == 8 and min(r["n_pixels"] for r in rows.values()) == 0
    exploded = stacks.seed_features(given, derived.seeds(spark, sf), params, spread=True).features.collect()
    assert len(exploded) == len(rows)
    for r in exploded:
        for name in r.__fields__:
            want = rows[r["seed_id"]][name]
            assert r[name] == (pytest.approx(want) if isinstance(want, float) else want), name


def test_tile_plan_orders_scenes_and_sets_mixed_shapes_apart(spark):
    from fallowlens.plans import tiles as plan
    from fallowlens.schemas import BANDS, Params

    bare, green = (0.05, 0.07, 0.10, 0.14, 0.25, 0.20), (0.05, 0.07, 0.10, 0.40, 0.25, 0.20)
    names = list(BANDS)

    def flat(values, n=1):
        return [v for v in values for _ in range(n)]

    rows = [
        ("a", dt.date(2024, 6, 1), 1, 1, T0, names, flat(bare), 1),
        ("a", dt.date(2024, 6, 2), 1, 1, T0, names, flat(bare), 1),
        ("a", dt.date(2024, 6, 2), 1, 1, T0, names, flat(green), 2),
        ("a", dt.date(2024, 7, 1), 1, 1, T0, names, flat(bare), 1),
        ("b", dt.date(2024, 6, 1), 1, 1, T0, names, flat(bare), 1),
        ("b", dt.date(2024, 6, 2), 2, 1, T0, names, flat(bare, 2), 1),
    ]
    schema = T.StructType(TILES.fields + [T.StructField("scene_idx", T.LongType())])
    tiles = spark.createDataFrame(rows, schema)
    seeds = spark.createDataFrame([("a", 45.0, 9.0), ("b", 45.0, 9.0)], "seed_id string, lat double, lon double")
    run = plan.seed_features(tiles, seeds, Params(min_obs=1), order="scene_idx")
    got = run.features.collect()
    assert [(r["seed_id"], r["n_pixels"], r["mean_n_obs_baresoil"]) for r in got] == [("a", 1, 1.0)]
    assert [(r["seed_id"], r["error"]) for r in run.errors.collect()] == [("b", "shape mismatch")]


def test_rasters_are_built_and_read_without_copies_of_bands(spark):
    sf = "/root/testdata/sf0.001"
    for df in (
        t.explode_pixels(derived.tiles(spark, sf), BANDS),
        t.explode_pixels(derived.tiles(spark, sf), BANDS, by_name=True, marked=True),
        t.explode_pixels(t.unstack_dates(derived.stacked_tiles(spark, sf), BANDS), BANDS),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "arrays_zip" not in plan and "map_from_entries" not in plan
        # seeds are joined, and dates gathered, while a group still is a list of cells
        assert plan.index("ArrowEvalPython") < plan.index("Join") < plan.index("Exchange")


@pytest.mark.parametrize("size", [(10, 10), (13, 11)])
def test_derived_rasters_hold_each_pixel_at_its_place(spark, monkeypatch, size):
    monkeypatch.setattr(derived, "CELLS_AT_ONCE", 7)
    sf, (width, height) = "/root/testdata/sf0.001", size
    wanted = {}
    for r in last_of_day(derived.scene_obs(spark, sf)).collect():
        raster = wanted.setdefault((r["seed_id"], r["acq_date"]), np.zeros((6, height, width), np.float32))
        raster[:, r["row"], r["col"]] = [r[b] for b in BANDS]
    tiles = derived.tiles(spark, sf, size).collect()
    assert len(tiles) == len(wanted)
    for r in tiles:
        assert np.array_equal(np.float32(r["data"]), wanted[r["seed_id"], r["date"]].reshape(-1))
    stacked = derived.stacked_tiles(spark, sf, size).collect()
    assert {r["seed_id"] for r in stacked} == {s for s, _ in wanted}
    for r in stacked:
        days = sorted(d for s, d in wanted if s == r["seed_id"])
        assert json.loads(json.loads(r["userdata"])["acquisition_dates"]) == [f"{d}T10:00:00Z" for d in days]
        assert np.array_equal(np.float32(r["data"]), np.concatenate([wanted[r["seed_id"], d].reshape(-1) for d in days]))


def test_short_arrays_and_empty_planes_explode_as_far_as_they_go(spark):
    day = dt.date(2024, 6, 1)
    df = tile(spark, [
        ("short", day, 2, 2, T0, ["B04", "B08"], [1.0, 2.0, 3.0, 4.0, 5.0]),
        ("first", day, 2, 2, T0, ["B04", "B08"], [1.0]),
        ("empty", day, 0, 2, T0, ["B04", "B08"], []),
        ("none", day, 2, 2, T0, ["B04", "B08"], None),
    ])
    by_place = [(r["seed_id"], r["B04"], r["B08"]) for r in t.explode_pixels(df, ["B04", "B08"]).orderBy("seed_id", "row", "col").collect()]
    assert by_place == [("first", 1.0, None), ("short", 1.0, 5.0), ("short", 2.0, None), ("short", 3.0, None), ("short", 4.0, None)]
    by_name = t.explode_pixels(df, ["B08", "B12"], by_name=True).collect()
    assert [(r["seed_id"], r["row"], r["col"], r["B08"], r["B12"]) for r in by_name] == [("short", 0, 0, 5.0, None)]
    marked = t.explode_pixels(df, ["B04"], marked=True).collect()
    assert sorted((r["seed_id"], r["row"], r["B04"]) for r in marked) == [("first", None, None), ("none", None, None), ("short", None, None)]


def test_bands_are_looked_up_once_a_tile_not_once_a_pixel(spark):
    day = dt.date(2024, 6, 1)
    df = tile(spark, [
        ("a", day, 2, 1, T0, ["B04", "B08"], [0.5, 0.1, 0.1, 0.5]),
        ("b", day, 1, 3, T0, ["B08", "B04"], [0.1, 0.5, 0.2, 0.5, 0.1, 0.6]),
        ("c", day, 2, 2, T0, ["B04"], [0.5, 0.1, 0.1, 0.5]),
        ("d", day, 2, 2, T0, ["B04", "B08"], [0.5]),
    ])
    pixels = t.explode_pixels(df, ["B04", "B08"], by_name=True, marked=True)
    bare = pixels.filter((ndvi() < 0.2) | F.col("row").isNull())
    text = bare._jdf.queryExecution().executedPlan().toString()
    # what lies above the explode is done for each pixel, a filter once for each time it names a band
    assert "Generate explode(_places" in text and "array_position" in text
    assert "array_position" not in text[: text.index("Generate explode")]
    got = [(r["seed_id"], r["row"], r["col"]) for r in bare.orderBy("seed_id", "row").collect()]
    assert got == [("a", 0, 0), ("b", 0, 0), ("b", 2, 0), ("d", None, None)]
