"""Seed features straight from stacked rasters.

Unstacking, same-day overwrite and exploding stay inside a stack's row. The bare
observations are then shuffled once, to their seed: with one stack per seed that
is a bounded group, the window's pixels times its dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.indices import add_indices, ndvi
from fallowlens.operators.bare_soil import pixel_statistics
from fallowlens.operators.quality import (
    coordinate_errors,
    duplicate_errors,
    duplicate_stack_errors,
    error_table,
    grid_errors,
    missing_errors,
    require_bands,
    stack_errors,
    without_errors,
)
from fallowlens.operators.spatial import seed_statistics
from fallowlens.operators.tiles import explode_pixels, in_interval, unstack_dates, with_dates
from fallowlens.plans.batch import SeedRun, with_run_metadata
from fallowlens.schemas import PIXEL_KEYS, Params, seed_columns


def pixel_stats(stacked: DataFrame, params: Params, spread: bool = False) -> DataFrame:
    """Statistics of pixels over their bare days in the interval. Expects one stack per seed.

    A seed's bare observations go to one place, which also serves the statistics per
    seed; ``spread`` deals rasters that are too large for that out by pixel.

    The corner pixel is kept even if it was never bare (its count is NULL then),
    so that a seed without bare soil still shows up.
    """
    require_bands(params.bands)
    pixels = explode_pixels(
        unstack_dates(stacked, params.bands, params.start_date, params.end_date), params.bands
    )
    bare = F.coalesce(ndvi() < params.ndvi_threshold, F.lit(False))
    corner = (F.col("row") == 0) & (F.col("col") == 0)
    kept = pixels.select(*PIXEL_KEYS, *params.bands, bare.alias("_bare")).filter(
        F.col("_bare") | corner
    )
    dealt = kept.repartition(*(PIXEL_KEYS if spread else ["seed_id"]))
    return pixel_statistics(add_indices(dealt), PIXEL_KEYS, params.targets, F.col("_bare"))


def seed_features(
    stacked: DataFrame, seeds: DataFrame, params: Params, spread: bool = False
) -> SeedRun:
    """Features and errors of all seeds; days outside the run's interval are not used.

    Seeds with several stacks are errors. Looking for them reads the id column
    alone, and their rows are dropped after the statistics, so no raster is shuffled.
    """
    spread = spread or params.spread
    points = seeds.select("seed_id", "lat", "lon").distinct()
    stats = seed_statistics(
        pixel_stats(stacked, params, spread), params.min_obs, params.size, spread=spread
    )
    inside = F.exists("dates", lambda d: in_interval(d, params.start_date, params.end_date))
    present = with_dates(stacked).filter(F.coalesce(inside, F.lit(False))).select("seed_id")
    errors = error_table(
        points,
        [
            coordinate_errors(points),
            duplicate_errors(points),
            duplicate_stack_errors(stacked),
            stack_errors(stacked, len(params.bands)),
            missing_errors(points, present),
            *([grid_errors(stats.select("seed_id", "in_grid"))] if params.size else []),
        ],
    )
    located = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    sound = without_errors(located, duplicate_errors(points))
    sound = without_errors(sound, duplicate_stack_errors(stacked))
    rows = sound.join(stats.filter("in_grid"), "seed_id")
    features = with_run_metadata(rows, params).select(*seed_columns(params.bands))
    return SeedRun(features, errors, sound.join(present, "seed_id", "left_semi"))
