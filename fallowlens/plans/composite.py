"""Composites of an area: median over the interval, or clearest acquisition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from fallowlens.operators.scenes import least_cloud_mosaic, median_mosaic, select_scenes
from fallowlens.schemas import BANDS, PIXEL_KEYS


def aoi_composite(
    obs: DataFrame,
    bbox: Sequence[float],
    start: str,
    end: str,
    max_cloud: int,
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = PIXEL_KEYS,
) -> DataFrame:
    """Median of the selected acquisitions for each pixel inside the box."""
    chosen = select_scenes(obs, start, end, max_cloud, bands, bbox)
    return median_mosaic(chosen, bands, keys)


def single_composite(
    obs: DataFrame,
    bbox: Sequence[float] | None,
    start: str,
    end: str,
    max_cloud: int,
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = PIXEL_KEYS,
) -> DataFrame:
    """One value per pixel and band from the clearest selected acquisition."""
    chosen = select_scenes(obs, start, end, max_cloud, bands, bbox)
    return least_cloud_mosaic(chosen, bands, keys)
