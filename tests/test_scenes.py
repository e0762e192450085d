import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fallowlens.operators import scenes
from fallowlens.plans.composite import aoi_composite, single_composite

SCHEMA = "seed_id string, row int, col int, acq_date date, scene_idx long, cloud_cover int, B04 double, B08 double"


def frame(spark, rows):
    return spark.createDataFrame(
        [("a", 0, c, dt.date(2024, 6, d), i, cloud, b4, b8) for c, d, i, cloud, b4, b8 in rows], SCHEMA
    )


def test_time_range_includes_the_whole_end_day(spark):
    stamps = ["2024-05-31 23:59:59", "2024-06-01 00:00:00", "2024-06-30 23:59:59.999", "2024-07-01 00:00:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.to_timestamp("s").alias("ts"))
    assert scenes.time_range(df, "2024-06-01", "2024-06-30", "ts").count() == 2


def test_cloud_limit_is_inclusive_and_needs_a_value(spark):
    df = spark.createDataFrame([(80,), (81,), (None,)], "cloud_cover int")
    assert [r[0] for r in scenes.cloud_at_most(df, 80).collect()] == [80]


def test_bbox_is_half_open(spark):
    df = spark.createDataFrame([(0.0, 0.0), (10.0, 5.0), (9.9, 5.0), (5.0, 10.0)], "x double, y double")
    assert scenes.inside_bbox(df, (0, 0, 10, 10)).count() == 2


def test_band_order_follows_the_request(spark):
    df = frame(spark, [(0, 1, 1, 10, 0.1, 0.2)])
    picked = scenes.select_scenes(df, "2024-06-01", "2024-06-30", 80, ["B08", "B04"])
    assert picked.columns[-2:] == ["B08", "B04"]


def test_last_scene_of_a_day_wins(spark):
    df = frame(spark, [(0, 1, 1, 10, 0.1, 0.2), (0, 1, 2, 10, 0.3, None), (0, 2, 1, 10, 0.5, 0.6)])
    got = scenes.last_of_day(df, ["B04", "B08"]).orderBy("acq_date").collect()
    assert [(r["B04"], r["B08"]) for r in got] == [(0.3, None), (0.5, 0.6)]


def test_least_cloud_prefers_clear_then_late(spark):
    df = frame(
        spark,
        [(0, 1, 1, 10, 0.1, 0.2), (0, 5, 1, 5, 0.3, 0.4), (0, 7, 1, 5, 0.5, 0.6), (0, 9, 1, 50, 0.7, 0.8)],
    )
    row = scenes.least_cloud_mosaic(df, ["B04", "B08"]).first()
    assert (row["B04"], row["B08"], row["cloud_cover"]) == (0.5, 0.6, 5)
    clear = single_composite(df, None, "2024-06-01", "2024-06-06", 80, ["B04"]).first()
    assert clear["B04"] == 0.3


def test_median_mosaic_honours_bands(spark):
    df = frame(spark, [(0, d, 1, 10, v, 1.0) for d, v in ((1, 0.1), (2, 0.9), (3, 0.4), (4, 0.5))])
    for quantised in (True, False):
        row = scenes.median_mosaic(df, ["B04"], quantised=quantised).first()
        assert row["B04"] == pytest.approx(0.45)
    placed = df.withColumns({"x": F.lit(5.0), "y": F.lit(5.0)})
    area = aoi_composite(placed, (0, 0, 10, 10), "2024-06-01", "2024-06-02", 20, ["B04"])
    assert area.first()["B04"] == pytest.approx(0.5) and "B08" not in area.columns


@pytest.mark.parametrize("src,dst,size", [(20, 10, 20), (10, 20, 5), (10, 15, 7), (15, 10, 12), (20, 60, 4)])
def test_resampling_takes_the_cell_holding_the_centre(spark, src, dst, size):
    n = 10
    df = spark.createDataFrame([(r, c, r * 100 + c) for r in range(n) for c in range(n)], "row int, col int, v int")
    got = {
        (r["row"], r["col"]): r["v"]
        for r in scenes.resample_nearest(df, float(src), float(dst), (size, size)).collect()
    }
    at = lambda i: math.floor((i + 0.5) * dst / src)
    want = {
        (r, c): at(r) * 100 + at(c)
        for r in range(size)
        for c in range(size)
        if at(r) < n and at(c) < n
    }
    assert got == want


def test_series_is_ordered_by_day(spark):
    df = frame(spark, [(0, d, 1, 10, d / 10, 0.0) for d in (5, 1, 3)])
    series = scenes.pixel_series(df, ["B04"]).first()["series"]
    assert [s["B04"] for s in series] == [0.1, 0.3, 0.5]
    assert scenes.orbit_dates(df).count() == 3 and scenes.orbit_stack(df, ["B04"]).count() == 3


def test_clearest_scenes_are_reduced_where_pixels_met(spark, tmp_path):
    """No buffers per pixel at the scan; a pixel with a third of the rows is still divided."""
    path = str(tmp_path / "o")
    spark.range(0, 90_000, 1, 6).selectExpr("id", "if(id % 3 = 0, 0, id % 7001) as k",
        "cast(id * 7919 % 101 as int) as cloud_cover", "date'2024-06-01' as acq_date", "id as scene_idx", "id / 4 as B04").write.parquet(path)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        found = scenes.least_cloud_mosaic(spark.read.parquet(path), ["B04"], ["k"])
        got = {r["k"]: (r["cloud_cover"], r["B04"]) for r in found.collect()}
    finally:
        spark.conf.set(size, before)
    best = {}
    for i in range(90_000):
        k, rank = (0 if i % 3 == 0 else i % 7001), (i * 7919 % 101, -i)
        best[k] = min(best.get(k, rank), rank)
    assert got == {k: (cloud, -i / 4) for k, (cloud, i) in best.items()}
    ran = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    reduced, met = ran.split("REBALANCE_PARTITIONS_BY_COL")
    assert "partial_min_by" in reduced and "Aggregate" not in met and "skewed" in reduced
