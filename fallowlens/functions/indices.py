"""Spectral indices as column expressions.

Missing values are NULL throughout, never NaN: Spark aggregates skip NULL only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.schemas import BANDS


def nan_to_null(c: Column) -> Column:
    """Widen to double and turn NaN into NULL."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def clean_bands(df: DataFrame, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Widen the band columns to double and turn their NaN into NULL."""
    return df.withColumns({b: nan_to_null(F.col(b)) for b in bands})


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL where the denominator is zero or missing."""
    return F.when(den != 0, num / den)


def normalized_difference(a: Column, b: Column) -> Column:
    return safe_ratio(a - b, a + b)


def msavi(nir: Column, red: Column) -> Column:
    t = F.pow(2 * nir + 1, F.lit(2)) - 8 * (nir - red)
    # `when`, not `greatest`: greatest(NULL, 0) is 0 and would hide a missing band
    clamped = F.when(t < 0, F.lit(0.0)).otherwise(t)
    return (2 * nir + 1 - F.sqrt(clamped)) / 2


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return safe_ratio(2.5 * (nir - red), nir + 6 * red - 7.5 * blue + 1)


def index_columns(band: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """The six indices, keyed by output name. ``band`` gives the column of a band."""
    blue, green, red, nir, swir1, swir2 = (band(b).cast("double") for b in BANDS)
    return {
        "NDVI": normalized_difference(nir, red),
        "NDMI": normalized_difference(nir, swir1),
        "NDWI": normalized_difference(green, nir),
        "NBR": normalized_difference(nir, swir2),
        "MSAVI": msavi(nir, red),
        "EVI": evi(nir, red, blue),
    }


def ndvi(band: Callable[[str], Column] = F.col) -> Column:
    return normalized_difference(band("B08").cast("double"), band("B04").cast("double"))


def add_indices(df: DataFrame) -> DataFrame:
    """Append the six indices; use as ``df.transform(add_indices)``."""
    missing = [b for b in BANDS if b not in df.columns]
    if missing:
        raise ValueError(f"indices need bands {list(BANDS)}, missing {missing}")
    return df.withColumns({name: nan_to_null(c) for name, c in index_columns().items()})
