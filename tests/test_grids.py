"""Grids by place: blocks, gaps, faults and plan."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fallowlens.operators import grids, scenes
from fallowlens.operators import tiles as t
from fallowlens.operators.quality import error_table
from fallowlens.plans import tiles as tile_plans
from fallowlens.schemas import BANDS, Params
from fallowlens.sources import derived

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sparse(spark, tmp_path_factory):
    """Two seeds of 70 x 45 and 33 x 64 cells, a third of them with a pixel."""
    rng = np.random.default_rng(0)
    rows = []
    for seed, h, w in (("a", 70, 45), ("b", 33, 64)):
        for k in rng.choice(h * w, h * w // 3, replace=False):
            r, c = divmod(int(k), w)
            rows.append((seed, r, c, float(k), None if k % 5 == 0 else float(k) / 7, int(k % 4)))
    path = str(tmp_path_factory.mktemp("px") / "px")
    spark.createDataFrame(rows, "seed_id string, row int, col int, NDVI_median_bs double, NDMI_median_bs double, n_obs_baresoil long").write.parquet(path)
    return spark.read.parquet(path), rows


SHAPES = [("a", 45, 70), ("b", 64, 33), ("c", 5, 3)]


def maps(rows):
    out = {s: (np.zeros((h, w), int), np.full((h, w), np.nan)) for s, w, h in SHAPES}
    for seed, r, c, ndvi, _, n in rows:
        out[seed][0][r, c], out[seed][1][r, c] = n, ndvi
    return out


def test_whole_grids_equal_plain_arrays(spark, sparse):
    px, rows = sparse
    shapes = spark.createDataFrame(SHAPES, "seed_id string, width int, height int")
    got = {r["seed_id"]: r for r in grids.qa_grids(px, seeds=shapes).collect()}
    for seed, (n_obs, ndvi) in maps(rows).items():
        assert np.array_equal(np.array(got[seed]["n_obs"]), n_obs)
        assert np.allclose(np.array(got[seed]["ndvi"], float), ndvi, equal_nan=True)


def test_blocks_make_up_the_whole_grid(spark, sparse):
    px, rows = sparse
    shapes = spark.createDataFrame(SHAPES, "seed_id string, width int, height int")
    blocks = grids.qa_grids(px, seeds=shapes, block=16).collect()
    assert len(blocks) == 5 * 3 + 3 * 4 + 1
    got = {s: np.full((h, w), -1) for s, w, h in SHAPES}
    for b in blocks:
        n = np.array(b["n_obs"])
        assert max(n.shape) <= 16 and (b["row0"], b["col0"]) == (16 * b["block_row"], 16 * b["block_col"])
        got[b["seed_id"]][b["row0"] : b["row0"] + n.shape[0], b["col0"] : b["col0"] + n.shape[1]] = n
    assert all(np.array_equal(got[s], m[0]) for s, m in maps(rows).items())
    cells = lambda df: {tuple(r) for r in grids.grid_cells(df, ["n_obs"]).select("seed_id", "row", "col", "n_obs").collect()}
    assert cells(grids.qa_grids(px, seeds=shapes)) == cells(grids.qa_grids(px, seeds=shapes, block=16))
    named = grids.composite_grids(px.withColumn("B04_median_bs", F.col("NDVI_median_bs")), bands=["B04"], seeds=shapes, block=40)
    assert set(named.columns) == {"seed_id", *grids.BLOCK_KEYS, "band", "grid"} and named.count() == 2 * 2 + 2 + 1


def test_a_large_grid_is_dealt_over_tasks(spark, tmp_path):
    n = 640
    path = str(tmp_path / "px")
    spark.range(n * n).select(
        F.lit("a").alias("seed_id"), (F.col("id") / n).cast("int").alias("row"), (F.col("id") % n).cast("int").alias("col"),
        F.col("id").cast("double").alias("NDVI_median_bs"), F.lit(0.5).alias("NDMI_median_bs"), F.lit(1).cast("long").alias("n_obs_baresoil"),
    ).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = grids.qa_grids(spark.read.parquet(path), (n, n), block=64).withColumn("task", F.spark_partition_id())
        per_task = blocks.groupBy("task").agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) >= 6 and sum(r["n"] for r in per_task) == 100 and max(r["n"] for r in per_task) < 40


def test_pixels_move_once(sparse):
    px, _ = sparse
    assert plan(grids.qa_grids(px, (64, 70))).count("Exchange hashpartitioning") == 1


def test_repeated_places_and_faults(spark):
    px = spark.createDataFrame(
        [("a", 0, 0, 0.5, 0.1, 3), ("a", 0, 0, 0.25, 0.1, 2), ("b", -1, 0, 0.5, 0.1, 1), ("b", 0, 0, 0.5, 0.1, 1), ("c", None, 0, 0.5, 0.1, 1)],
        "seed_id string, row int, col int, NDVI_median_bs double, NDMI_median_bs double, n_obs_baresoil long",
    )
    for block in (None, 2):
        got = grids.qa_grids(px, (2, 1), block=block).collect()
        assert [(r["seed_id"], r["n_obs"]) for r in got] == [("a", [[2, 0]])]
    seeds = spark.createDataFrame([(s, 1.0, 2.0) for s in "abc"], "seed_id string, lat double, lon double")
    errors = error_table(seeds, [grids.grid_faults(px, (2, 1))]).collect()
    assert {(r["seed_id"], r["error"]) for r in errors} == {("b", "shape mismatch"), ("c", "shape mismatch")}


def test_truncated_rasters_end_as_errors(spark):
    tiles, seeds = derived.tiles(spark, SF), derived.seeds(spark, SF)
    late = (F.col("seed_id") == "seed_0002") & (F.dayofmonth("date") > 20)
    long = (F.col("seed_id") == "seed_0003") & (F.dayofmonth("date") == 2)
    data = F.when(late, F.slice("data", 1, 598)).when(long, F.concat("data", F.array(F.lit(1.0).cast("float")))).otherwise(F.col("data"))
    for size in ((10, 10), None):
        run = tile_plans.seed_features(tiles.withColumn("data", data), seeds, Params(size=size))
        assert {(r["seed_id"], r["error"]) for r in run.errors.collect()} == {("seed_0002", "shape mismatch"), ("seed_0003", "shape mismatch")}
        done = {r["seed_id"] for r in run.features.select("seed_id").collect()}
        assert done == {r["seed_id"] for r in seeds.collect()} - {"seed_0002", "seed_0003"}
    assert len(re.findall(r"Scan parquet[^\n]*l_shipdate", plan(run.features))) <= 3


def test_first_transform_shuffles_no_raster(spark, tmp_path):
    derived.tiles(spark, SF).write.parquet(str(tmp_path / "t"))
    tiles = spark.read.parquet(str(tmp_path / "t"))
    text = plan(t.explode_pixels(t.with_first_transform(tiles), BANDS))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    moved = t.with_first_transform(tiles, most=1)
    assert "BroadcastHashJoin" in plan(moved) or moved.count() == tiles.count()


def test_clearest_scene_is_found_in_hash_buffers(spark, tmp_path):
    derived.scene_obs(spark, SF).write.parquet(str(tmp_path / "o"))
    obs = spark.read.parquet(str(tmp_path / "o"))
    text = plan(scenes.least_cloud_mosaic(obs))
    assert "SortAggregate" not in text and "partial_min_by" in text
    # the same rows as by comparing fields, which other types still do
    want = scenes.least_cloud_mosaic(obs.withColumn("cloud_cover", F.col("cloud_cover").cast("double")))
    key = lambda r: (r["seed_id"], r["row"], r["col"])
    assert sorted(scenes.least_cloud_mosaic(obs).collect(), key=key) == sorted(want.collect(), key=key)


def test_clearest_first_orders_extremes_and_missing_values(spark):
    rows = [
        ("a", 5, "2024-06-01", 1, 1.0), ("a", 5, "2024-06-02", -(2**63), 2.0), ("a", 6, "2024-06-30", 9, 3.0),
        ("b", 5, "2024-06-02", 2**63 - 1, 1.0), ("b", 5, "2024-06-02", 2**63 - 2, 2.0), ("b", None, "2024-06-03", 1, 3.0),
        ("c", 0, None, 5, 1.0), ("c", 0, "0001-01-01", None, 2.0), ("c", 0, None, None, 3.0),
        ("d", 100, "9999-12-31", 0, 1.0), ("d", 101, "9999-12-31", 0, 2.0), ("d", 2**31 - 1, "9999-12-31", 7, 3.0),
    ]
    df = spark.createDataFrame(rows, "k string, cloud_cover int, day string, scene_idx long, B04 double").withColumn("acq_date", F.col("day").cast("date"))
    for kind in ("int", "double"):
        found = scenes.least_cloud_mosaic(df.withColumn("cloud_cover", F.col("cloud_cover").cast(kind)), ["B04"], ["k"]).collect()
        want = {"a": 2.0, "b": 1.0, "c": 2.0, "d": 1.0}
        if kind == "double":
            want.pop("b")  # numbers beyond doubles tie there
        assert {r["k"]: r["B04"] for r in found if r["k"] in want} == want
