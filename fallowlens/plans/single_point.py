"""One point from its time series: the forms without seed keys.

They differ from the batch in three ways: the series carries no bare-soil flag,
the count of under-observed pixels is blanked with their features, and the point
row names the minimum number of observations instead of the cloud limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.operators.grids import composite_grids, qa_grids
from fallowlens.plans import batch
from fallowlens.schemas import (
    BANDS,
    INDICES,
    Params,
    pixel_columns,
    spatial_names,
    temporal_names,
    timeseries_columns,
)


def series_columns(bands: tuple[str, ...] = BANDS) -> list[str]:
    dropped = {"seed_id", "seed_lat", "seed_lon", "is_baresoil"}
    return [c for c in timeseries_columns(bands) if c not in dropped]


def point_columns(bands: tuple[str, ...] = BANDS) -> list[str]:
    return [
        "lat",
        "lon",
        "window_m",
        "start_date",
        "end_date",
        "min_obs_baresoil",
        "n_pixels",
        "n_pixels_with_min_obs",
        "mean_n_obs_baresoil",
        "median_n_obs_baresoil",
        *spatial_names(temporal_names(tuple(bands) + INDICES)),
    ]


@dataclass(frozen=True)
class PointRun:
    series: DataFrame
    pixels: DataFrame
    composite: DataFrame
    maps: DataFrame


def aggregate_point(daily: DataFrame, seeds: DataFrame, params: Params) -> PointRun:
    """Series, pixel features, median composite and maps of each given point."""
    series = batch.pixel_timeseries(daily, seeds, params)
    pixels = batch.pixel_features(daily, seeds, params, mask_n_obs=True)
    return PointRun(
        series.select(*series_columns(params.bands)),
        pixels.select(*pixel_columns(params.bands)),
        composite_grids(pixels, params.size, params.bands),
        qa_grids(pixels, params.size),
    )


def point_row(features: DataFrame, params: Params) -> DataFrame:
    """Seed features in the single-point layout."""
    named = features.withColumn("min_obs_baresoil", F.lit(params.min_obs))
    return named.select(*point_columns(params.bands))
