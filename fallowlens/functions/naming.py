"""Names used as keys: survey points and mosaics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point_name(lat: Column, lon: Column) -> Column:
    """``point_44p891531_10p012636``; NULL without coordinates."""
    name = F.replace(F.format_string("point_%.6f_%.6f", lat, lon), F.lit("."), F.lit("p"))
    return F.when(lat.isNotNull() & lon.isNotNull(), name)


def mosaic_name(
    collection: Column,
    from_date: Column,
    to_date: Column,
    bands: Column | None = None,
    width: Column | None = None,
    height: Column | None = None,
    suffix: Column | None = None,
) -> Column:
    """``collection_from_to[_bands][_WxH][_suffix]``; absent parts are skipped."""
    parts = [collection, from_date, to_date]
    if bands is not None:
        parts.append(F.when(F.size(bands) > 0, F.array_join(bands, "-")))
    if width is not None and height is not None:
        sized = (width != 0) & (height != 0)
        parts.append(
            F.when(sized, F.concat(width.cast("string"), F.lit("x"), height.cast("string")))
        )
    if suffix is not None:
        parts.append(F.nullif(suffix, F.lit("")))
    return F.concat_ws("_", *parts)

