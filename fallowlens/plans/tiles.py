"""Seed features from per-date rasters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.operators.quality import band_errors, raster_errors, require_bands, shape_errors
from fallowlens.operators.scenes import time_range
from fallowlens.operators.tiles import explode_pixels, last_of_day_tiles
from fallowlens.plans.batch import SeedRun, consolidate, pixel_stats
from fallowlens.schemas import Params


def daily_from_tiles(tiles: DataFrame, params: Params, order: str | None = None) -> DataFrame:
    """Pixels of the run's dates. ``order`` numbers the tiles of a seed and day;
    without it there must be one tile per seed and day. A tile with too few or too many
    values gives one row without place and bands."""
    require_bands(params.bands)
    chosen = time_range(tiles, params.start_date, params.end_date, "date")
    if order is not None:
        chosen = last_of_day_tiles(chosen, order)
    return explode_pixels(chosen, params.bands, by_name=True, marked=True).withColumnRenamed("date", "acq_date")


def seed_features(
    tiles: DataFrame, seeds: DataFrame, params: Params, order: str | None = None
) -> SeedRun:
    """Features and errors.

    Seeds whose tiles differ in shape, lack a band or hold too few or too many values are
    errors, and so are those with a raster that ``read_rasters`` could not decode or date.
    """
    failed = []
    if "error" in tiles.columns:
        failed.append(raster_errors(tiles))
        tiles = tiles.filter(F.col("error").isNull()).drop("error")
    chosen = time_range(tiles, params.start_date, params.end_date, "date")
    pixels = pixel_stats(daily_from_tiles(tiles, params, order), params, marked=True)
    observed = chosen.select("seed_id").distinct()
    failed += [band_errors(chosen, params.bands), shape_errors(chosen, with_data=False)]
    # for the features the marked pixels tell of rasters of a wrong length, without a second scan
    return consolidate(pixels, seeds, observed, params, failed, marked=True, told=[shape_errors(chosen)])
