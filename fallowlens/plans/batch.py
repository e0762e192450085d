"""Bare-soil features of all seeds in one plan.

Shuffles of ``seed_features``: pixel-day (same-day overwrite, combined on the map
side), pixel (bare rows only), seed (one row per pixel). No key that can grow
without bound is ever gathered: a pixel has at most one row per day of the run,
a seed at most one row per cell of its grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.geo import with_pixel_centres
from fallowlens.functions.indices import add_indices, clean_bands, ndvi
from fallowlens.operators.bare_soil import flag_bare_soil, mask_min_obs, pixel_statistics
from fallowlens.operators.quality import (
    coordinate_errors,
    duplicate_errors,
    error_table,
    grid_errors,
    missing_errors,
    observation_errors,
    require_bands,
    unique_points,
    without_errors,
)
from fallowlens.operators.scenes import last_of_day, select_scenes
from fallowlens.operators.spatial import attach_to_seeds, seed_statistics
from fallowlens.schemas import (
    ERRORS,
    PIXEL_KEYS,
    Params,
    pixel_columns,
    pixel_schema,
    seed_columns,
    seed_schema,
    timeseries_columns,
    timeseries_schema,
)
from fallowlens.session import materialize
from fallowlens.sources import sinks
from fallowlens.streaming import runs


def daily_pixels(obs: DataFrame, params: Params) -> DataFrame:
    """Selected scenes, one row per pixel and day."""
    require_bands(params.bands)
    chosen = select_scenes(obs, params.start_date, params.end_date, params.max_cloud)
    return last_of_day(clean_bands(chosen, params.bands), params.bands)


def pixel_timeseries(daily: DataFrame, seeds: DataFrame, params: Params) -> DataFrame:
    """The 21-column time series. ``seeds`` brings ``lat, lon, transform``."""
    placed = daily.join(unique_points(seeds), "seed_id").withColumnsRenamed(
        {"lat": "seed_lat", "lon": "seed_lon", "acq_date": "date"}
    )
    flagged = flag_bare_soil(add_indices(with_pixel_centres(placed)), params.ndvi_threshold)
    return flagged.select(*timeseries_columns(params.bands))


def pixel_stats(daily: DataFrame, params: Params, marked: bool = False, dealt: bool = False) -> DataFrame:
    """Statistics of bare pixels over time, before any masking.

    With ``marked`` rows without a place, which tell of a fault in their seed, stay.
    ``dealt`` tells that the rows already lie by seed, as in ``sinks.write_bucketed``.
    """
    # a stored time series carries the flag, which then filters at the scan
    flagged = "is_baresoil" in daily.columns
    is_bare = F.col("is_baresoil") if flagged else ndvi() < params.ndvi_threshold
    if marked:
        is_bare = is_bare | F.col("row").isNull()
    bare = daily.filter(is_bare).select(*PIXEL_KEYS, *params.bands)
    # Only band values travel; indices are computed where they are aggregated.
    spread = bare if dealt else bare.repartition(*PIXEL_KEYS)
    return pixel_statistics(add_indices(spread), PIXEL_KEYS, params.targets)


def pixel_features(
    daily: DataFrame, seeds: DataFrame, params: Params, mask_n_obs: bool = False
) -> DataFrame:
    """The 44-column pixel table: seed keys, pixel keys, statistics, count."""
    masked = mask_min_obs(pixel_stats(daily, params), params.min_obs, PIXEL_KEYS, mask_n_obs)
    placed = with_pixel_centres(masked.join(unique_points(seeds), "seed_id"))
    return placed.withColumnsRenamed({"lat": "seed_lat", "lon": "seed_lon"}).select(
        "seed_id", "seed_lat", "seed_lon", *pixel_columns(params.bands)
    )


def with_run_metadata(df: DataFrame, params: Params) -> DataFrame:
    return df.withColumns(
        {
            "window_m": F.lit(float(params.window_m)),
            "start_date": F.lit(params.start_date),
            "end_date": F.lit(params.end_date),
            "ndvi_threshold": F.lit(float(params.ndvi_threshold)),
            "max_cloud_coverage": F.lit(int(params.max_cloud)),
        }
    )


@dataclass(frozen=True)
class SeedRun:
    """The two outcomes of a batch: a seed is in exactly one of them.

    ``processed`` are the points behind the features, for cheap emptiness checks.
    """

    features: DataFrame
    errors: DataFrame
    processed: DataFrame


def consolidate(
    pixels: DataFrame,
    seeds: DataFrame,
    observed: DataFrame,
    params: Params,
    failed: Sequence[DataFrame] = (),
    marked: bool = False,
    told: Sequence[DataFrame] = (),
    complete: bool = False,
) -> SeedRun:
    """Seed rows from pixel rows. ``observed`` holds the ids of seeds with data, and
    ``unordered`` if their observations have an order; ``failed`` are the findings of
    further checks. Only a declared grid makes the errors read the pixels. ``marked``
    pixels without a place keep their seed from the features; ``told`` are the same
    faults for the error table. ``complete`` pixels hold every seed with data, also one that was
    never bare, and mark those without an order; the features then do not read ``observed``.

    Equal rows of one seed count once; a seed listed with different rows is an error.
    """
    points = seeds.select("seed_id", "lat", "lon").distinct()
    if params.spread:
        pixels = materialize(pixels)
    stats = seed_statistics(pixels, params.min_obs, params.size, spread=params.spread, marked=marked)
    ordered = "unordered" in observed.columns
    errors = error_table(
        points,
        [
            coordinate_errors(points),
            duplicate_errors(points),
            observation_errors(points, observed) if ordered else missing_errors(points, observed),
            *([grid_errors(stats.select("seed_id", "in_grid"))] if params.size else []),
            *failed,
            *told,
        ],
    )
    # The same rules again as filters: the features must not wait for the errors.
    located = points.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    usable = observed.filter(~F.col("unordered")) if ordered else observed
    listed = without_errors(located, duplicate_errors(points))
    for found in failed:
        listed = without_errors(listed, found)
    sound = listed.join(usable, "seed_id", "left_semi")
    if complete:
        rows = listed.join(stats.filter("in_grid"), "seed_id")
    else:
        rows = attach_to_seeds(sound, stats).filter(F.coalesce(F.col("in_grid"), F.lit(True)))
    features = with_run_metadata(rows, params).select(*seed_columns(params.bands))
    return SeedRun(features, errors, sound)


def observed_seeds(obs: DataFrame, params: Params) -> DataFrame:
    """Seeds with selected observations, and whether one of those lacks its scene number."""
    chosen = select_scenes(obs, params.start_date, params.end_date, params.max_cloud)
    return chosen.groupBy("seed_id").agg(F.bool_or(F.col("scene_idx").isNull()).alias("unordered"))


def seed_features(obs: DataFrame, seeds: DataFrame, params: Params) -> SeedRun:
    """Features and errors of all seeds, straight from observations."""
    observed = observed_seeds(obs, params)
    pixels = pixel_stats(daily_pixels(obs, params), params)
    return consolidate(pixels, seeds, observed, params)


def store_run(found: SeedRun, run: runs.Run) -> dict[str, bool]:
    """Write both outcomes below the run's own number; tells which of them had rows."""
    spark = found.features.sparkSession
    done = sinks.write_seed_features(conform(found.features, seed_schema(run.params.bands)), run.path("seed_features"), found.processed)
    sinks.write_table(runs.outcomes(run.stored(spark, "seed_features"), found.errors), run.path("outcomes"))
    failed = run.stored(spark, "outcomes").filter(F.col("error").isNotNull())
    return {"features": done, "errors": sinks.write_errors(failed.select(*ERRORS.names), run.path("errors"))}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def run_one_seed(
    obs: DataFrame, seed_id: str, lat: float, lon: float, transform: list[float], params: Params
) -> SeedRun:
    """The same run for a single point; its observations are filtered at the scan."""
    spark = obs.sparkSession
    seed = spark.createDataFrame(
        [(seed_id, lat, lon, transform)],
        "seed_id string, lat double, lon double, transform array<double>",
    )
    return seed_features(obs.filter(F.col("seed_id") == seed_id), seed, params)


def run_batch(
    obs: DataFrame, seeds: DataFrame, params: Params, out: str, resume: bool = False
) -> dict[str, bool]:
    """Write time series, pixel features, seed features and errors below ``out``, and publish them.

    Each stage starts from the stored result of the one before, so nothing is
    computed twice and a lost executor costs one stage at most. Read the tables with
    ``runs.published``: a seed's rows are those of the last published run that had it.
    ``resume`` leaves out the seeds that such a run has finished with the same parameters.
    """
    spark = obs.sparkSession
    if resume:
        seeds = materialize(runs.pending(seeds, out, params))
        if seeds.isEmpty():
            return {"features": False, "errors": False}
        obs = obs.join(seeds.select("seed_id").distinct(), "seed_id", "left_semi")
    run = runs.start(out, params)
    series = pixel_timeseries(daily_pixels(obs, params), seeds, params)
    sinks.write_timeseries(conform(series, timeseries_schema(params.bands)), run.path("pixel_timeseries"), params)
    pixels = pixel_features(run.stored(spark, "pixel_timeseries"), seeds, params)
    sinks.write_pixel_features(conform(pixels, pixel_schema(params.bands)), run.path("pixel_features"), params)
    found = consolidate(
        run.stored(spark, "pixel_features").select(*PIXEL_KEYS, *pixel_columns(params.bands)[4:]),
        seeds,
        observed_seeds(obs, params),
        params,
    )
    wrote = store_run(found, run)
    runs.publish(spark, run)
    return wrote
