"""Strips, buckets, cells along a curve and mergeable profiles."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from fallowlens.operators import profiles, windows
from fallowlens.operators import tiles as t
from fallowlens.plans import batch
from fallowlens.schemas import BANDS, Params
from fallowlens.sources import derived, sinks
from fallowlens.sources.rasters import read_strips

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_strips_hold_the_same_pixels_in_short_arrays(spark, tmp_path):
    derived.tiles(spark, SF).write.parquet(str(tmp_path / "t"))
    tiles = spark.read.parquet(str(tmp_path / "t"))
    key = lambda r: (r["seed_id"], r["date"], r["row"], r["col"])
    want = sorted(t.explode_pixels(tiles, BANDS).collect(), key=key)
    for most in (1, 130, 10_000):
        strips = t.strips(tiles, most)
        assert strips.agg(F.max(F.size("data"))).first()[0] <= max(most, 60)
        assert sorted(t.explode_pixels(strips, BANDS, by_name=True).collect(), key=key) == want
        assert "Exchange" not in plan(t.explode_pixels(strips, BANDS))
    strips = t.strips(tiles, 130)
    heights = tiles.select("seed_id", "date", "height")
    assert t.strip_errors(strips, heights).isEmpty()
    first = strips.orderBy("seed_id", "date", "row0").first()
    is_first = (F.col("seed_id") == first["seed_id"]) & (F.col("date") == first["date"])
    for broken in (
        strips.filter(~(is_first & (F.col("row0") == 4))),
        strips.unionByName(strips.filter(is_first & (F.col("row0") == 4))),
        strips.withColumn("data", F.when(is_first, F.slice("data", 1, 5)).otherwise(F.col("data"))),
        strips.withColumn("row0", F.when(is_first, F.col("row0") + 1).otherwise(F.col("row0"))),
    ):
        assert [tuple(r) for r in t.strip_errors(broken, heights).collect()] == [(first["seed_id"], first["date"])]


def test_a_stack_is_read_as_strips(spark, tmp_path):
    """More values in all than one strip may hold, from a decoder that never has the whole."""
    (tmp_path / "stack.tif").write_bytes(b"12 400 3")
    (tmp_path / "bad.tif").write_bytes(b"2 400 x")

    def decoder(raw):
        days, size, step = raw.split()
        for d in range(int(days)):
            for row0 in range(0, int(size), 100):
                yield {"date": dt.date(2024, 6, 1 + d), "width": int(size), "transform": [1.0] * 6, "bands": ["B04"], "row0": row0, "height": 100,
                       "data": [float(d * int(step))] * (100 * int(size))}

    strips = read_strips(spark, str(tmp_path), decoder)
    assert {r["error"].split(":")[0] for r in strips.filter("error is not null").collect()} == {"ValueError"}
    sound = strips.filter("error is null")
    assert sound.agg(F.max(F.size("data"))).first()[0] == 40_000
    px = t.explode_pixels(sound.withColumn("seed_id", F.lit("a")), ["B04"])
    found = px.groupBy("date").agg(F.count("*").alias("n"), F.max("row").alias("row"), F.max("B04").alias("v")).orderBy("date").collect()
    assert [(r["n"], r["row"], r["v"]) for r in found] == [(160_000, 399, 3.0 * d) for d in range(12)]


def test_bucketed_pixels_are_read_where_they_lie(spark, tmp_path):
    params = Params()
    daily = batch.daily_pixels(derived.scene_obs(spark, SF), params)
    series = batch.pixel_timeseries(daily, derived.seeds(spark, SF), params)
    sinks.write_bucketed(series, "layout_series", str(tmp_path / "series"), 4)
    try:
        stored = spark.table("layout_series")
        stats = batch.pixel_stats(stored, params, dealt=True)
        assert "Exchange" not in plan(stats)
        sinks.write_bucketed(stats, "layout_pixels", str(tmp_path / "pixels"), 4)
        from fallowlens.operators.spatial import seed_statistics

        seeds = seed_statistics(spark.table("layout_pixels"), params.min_obs)
        assert "Exchange" not in plan(seeds)
        want = seed_statistics(batch.pixel_stats(daily, params), params.min_obs)
        pick = lambda df: {r["seed_id"]: (r["n_pixels"], pytest.approx(r["B08_median_bs_space_mean"])) for r in df.collect()}
        assert pick(seeds) == pick(want)
    finally:
        for name in ("layout_series", "layout_pixels"):
            spark.sql(f"drop table if exists {name}")


def test_curve_numbers_interleave_the_bits(spark):
    cells = [(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (5, 9), (-1, -1), (-3, 70_000), (49_000, 497_000)]
    df = spark.createDataFrame([(x * 10 + 5.0, y * 10 + 5.0) for x, y in cells], "x double, y double")
    got = [r["z"] for r in df.select(windows.curve_cell(F.col("x"), F.col("y"), 10.0).alias("z")).collect()]
    half = 1 << 30
    plainly = [sum(((x + half) >> b & 1) << 2 * b | ((y + half) >> b & 1) << 2 * b + 1 for b in range(31)) for x, y in cells]
    assert got == plainly


def test_a_cell_s_number_names_its_coordinates_once(spark):
    """A costly coordinate is computed once a row; it stood in the expression 32 times for each side."""
    df = spark.range(3).select(windows.curve_cell(F.expr("sqrt(id)"), F.expr("cbrt(id)"), 10.0).alias("z"))
    assert plan(df).upper().count("SQRT") <= 2 and plan(df).upper().count("CBRT") <= 2


def test_one_spot_with_half_of_all_rows_is_dealt_evenly(spark, tmp_path):
    rng = random.Random(0)
    spots = [(55.0, 55.0)] * 6000 + [(rng.uniform(0, 2000), rng.uniform(0, 2000)) for _ in range(6000)]
    spark.createDataFrame([(x, y, float(i)) for i, (x, y) in enumerate(spots)], "x double, y double, v double").write.parquet(str(tmp_path / "o"))
    obs = spark.read.parquet(str(tmp_path / "o"))
    boxes = [(f"s{i}", 20.0 + 100 * i, 20.0, 90.0 + 100 * i, 90.0) for i in range(8)] + [("twin", 50.0, 50.0, 60.0, 60.0)]
    edges = spark.createDataFrame(boxes, "seed_id string, minx double, miny double, maxx double, maxy double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = windows.dealt_window_join(obs, edges, 100.0, 50)
        assert "BroadcastHashJoin" not in plan(joined).split("SortMergeJoin")[0]
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        got = sorted((r["seed_id"], r["v"]) for r in joined.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted((s, float(i)) for i, (x, y) in enumerate(spots) for s, a, b, c, d in boxes if a <= x < c and b <= y < d)
    assert got == want and len(sizes) >= 15 and max(sizes) < 2.5 * sum(sizes) / 16


def test_profiles_of_parts_add_up(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"d{i % 6}", i, f"v{min(int(rng.expovariate(0.2)), 400)}", None if i % 7 == 0 else rng.gauss(100, 15)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "day string, n long, name string, x double")
    path = str(tmp_path / "sketches")
    for days in (("d0", "d1"), ("d2", "d3", "d4"), ("d5",), ("d0",)):
        profiles.add_part(profiles.profile_sketches(df.filter(F.col("day").isin(*days)), ["day"]), path, ["day"])
    stored = spark.read.parquet(path)
    assert stored.count() == 6 * 3
    got = {r["column"]: r for r in profiles.merged_profile(stored).collect()}
    xs = sorted(x for *_, x in rows if x is not None)
    mean = sum(xs) / len(xs)
    r = got["x"]
    assert (r["rows"], r["nulls"], r["low"], r["high"]) == (30_000, 30_000 - len(xs), xs[0], xs[-1])
    assert r["mean"] == pytest.approx(mean) and r["std"] == pytest.approx(math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)))
    # measured against the exact form: distinct values within 3 %, quantiles within 1.5 % of the rank
    assert abs(got["n"]["distinct"] / 30_000 - 1) < 0.03 and abs(r["distinct"] / len(set(xs)) - 1) < 0.03
    for q in (25, 50, 75):
        rank = sum(x <= r[f"q{q}"] for x in xs) / len(xs)
        assert abs(rank - q / 100) < 0.015
    counts = {}
    for _, _, name, _ in rows:
        counts[name] = counts.get(name, 0) + 1
    best = sorted(counts.items(), key=lambda p: -p[1])[:5]
    assert [(x["item"], x["count"]) for x in got["name"]["top"]] == best
    assert (got["name"]["low_text"], got["name"]["mean"]) == (min(counts), None)
    assert plan(profiles.profile_sketches(df)).count("Exchange") == 1
    assert profiles.merged_profile(profiles.profile_sketches(df.limit(0), ["day"])).isEmpty()
