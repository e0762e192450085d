"""Scene selection, mosaics, resampling and same-day overwrite.

Every reduction here combines before its shuffle, with constant state per group, so one
pixel or one day holding much of the data costs no more than others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.indices import clean_bands
from fallowlens.operators.quantiles import grouped_quantiles
from fallowlens.schemas import BANDS, PIXEL_KEYS


def time_range(df: DataFrame, start: str, end: str, ts: str = "acq_date") -> DataFrame:
    """Rows from the start day up to the last instant of the end day."""
    after = dt.date.fromisoformat(end) + dt.timedelta(days=1)
    kind = df.schema[ts].dataType
    return df.filter(
        (F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(after.isoformat()).cast(kind))
    )


def cloud_at_most(df: DataFrame, limit: int, cloud: str = "cloud_cover") -> DataFrame:
    """Scene-level cloud filter; a missing cloud cover does not pass."""
    return df.filter(F.col(cloud) <= limit)


def in_box(x: Column, y: Column, minx, miny, maxx, maxy) -> Column:
    """Half-open, so a point on a shared border lies in one box only."""
    return (x >= minx) & (x < maxx) & (y >= miny) & (y < maxy)


def inside_bbox(
    df: DataFrame, bbox: Sequence[float], x: str = "x", y: str = "y"
) -> DataFrame:
    return df.filter(in_box(F.col(x), F.col(y), *[F.lit(float(v)) for v in bbox]))


def project_bands(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """Requested bands in requested order; the scan reads no others."""
    return df.select(*keys, *bands)


def select_scenes(
    df: DataFrame,
    start: str,
    end: str,
    max_cloud: int,
    bands: Sequence[str] | None = None,
    bbox: Sequence[float] | None = None,
    ts: str = "acq_date",
) -> DataFrame:
    """Time, cloud, area and band selection in one pushed-down step."""
    out = cloud_at_most(time_range(df, start, end, ts), max_cloud)
    if bbox is not None:
        out = inside_bbox(out, bbox)
    if bands is not None:
        drop = [b for b in BANDS if b in df.columns and b not in bands]
        keys = [c for c in df.columns if c not in drop and c not in bands]
        out = project_bands(out, keys, bands)
    return out


def last_of_day(
    df: DataFrame,
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = PIXEL_KEYS,
    date: str = "acq_date",
    order: str = "scene_idx",
) -> DataFrame:
    """One row per pixel and day: that of the highest scene number.

    ``order`` is one number column that differs between the acquisitions of a
    pixel, which keeps the whole aggregate in fixed-width hash buffers.
    """
    return df.groupBy(*keys, date).agg(*[F.max_by(b, order).alias(b) for b in bands])


def orbit_stack(
    df: DataFrame, bands: Sequence[str] = BANDS, keys: Sequence[str] = PIXEL_KEYS
) -> DataFrame:
    """Every acquisition, no temporal reduction, in long form."""
    return df.select(*keys, "acq_date", "scene_idx", *bands)


def orbit_dates(df: DataFrame) -> DataFrame:
    """Acquisition days of each seed with their number of scenes."""
    scenes = df.select("seed_id", "acq_date", "scene_idx").distinct()
    return scenes.groupBy("seed_id", "acq_date").agg(F.count("*").alias("n_scenes"))


def pixel_series(
    daily: DataFrame, bands: Sequence[str] = BANDS, keys: Sequence[str] = PIXEL_KEYS
) -> DataFrame:
    """Stacked form: one date-ordered array per pixel, one entry per day at most."""
    entry = F.struct("acq_date", *bands)
    return daily.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("series"))


def median_mosaic(
    df: DataFrame,
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = PIXEL_KEYS,
    quantised: bool = True,
) -> DataFrame:
    """Median per pixel and band over all acquisitions.

    Reflectances are 16-bit counts over 1e4, so the value counts ``median`` keeps
    are bounded whatever the number of rows. Use ``quantised=False`` for bands
    of any value; it finds the same medians without holding a group in one task.
    """
    df = clean_bands(df, bands)
    if quantised:
        return df.groupBy(*keys).agg(*[F.median(b).alias(b) for b in bands])
    return grouped_quantiles(df, keys, {b: {b: 0.5} for b in bands})


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType)


def clearest_first(df: DataFrame, ts: str, scene: str, cloud: str = "cloud_cover") -> Column:
    """A key that orders acquisitions: least cloud, then latest, then highest scene number.

    Whole cloud percentages, days and scene numbers are packed into one decimal number, which
    aggregates keep in fixed-width hash buffers. Other types are compared as a struct. A
    missing cloud cover counts as the cloudiest, a missing day or number as the earliest.
    """
    kinds = {c: df.schema[c].dataType for c in (cloud, ts, scene)}
    if not (
        isinstance(kinds[cloud], _WHOLE) and isinstance(kinds[ts], T.DateType) and isinstance(kinds[scene], (*_WHOLE, T.LongType))
    ):
        recency = -F.unix_micros(F.col(ts).cast("timestamp"))
        parts = {"cloud": F.col(cloud).cast("double"), "recency": recency.cast("double"), "scene": -F.col(scene).cast("double")}
        return F.struct(*[F.coalesce(v, F.lit(float("inf"))).alias(k) for k, v in parts.items()])
    # eight digits of days and twenty of scene numbers, each turned round and made positive
    days = F.coalesce(F.lit(40_000_000) - F.unix_date(F.col(ts)), F.lit(99_999_999))
    cover = F.coalesce(F.col(cloud).cast("long"), F.lit(2**31))
    number = F.expr("10000000000000000000BD") - F.col(scene).cast("decimal(19,0)")
    number = F.coalesce(number, F.expr("99999999999999999999BD"))
    ahead = (cover * 10**8 + days).cast("decimal(18,0)") * F.expr("100000000000000000000BD")
    return (ahead + number).cast("decimal(38,0)")


def least_cloud_mosaic(
    df: DataFrame,
    bands: Sequence[str] = BANDS,
    keys: Sequence[str] = PIXEL_KEYS,
    ts: str = "acq_date",
    scene: str = "scene_idx",
) -> DataFrame:
    """Values of the clearest acquisition; the latest one among equals.

    Acquisitions of a pixel meet before they are reduced, in parts of about equal size: a
    part of the input may hold as many pixels as rows, and each takes a wide buffer. A pixel
    that holds much of the data is divided by adaptive execution, so its parts are combined
    once more.
    """
    values = ["cloud_cover", ts, *bands]
    keyed = clean_bands(df, bands).select(
        *keys, *values, clearest_first(df, ts, scene).alias("_key"), F.xxhash64(*keys).alias("_place")
    )
    met = keyed.hint("rebalance", "_place")
    return met.groupBy(*keys).agg(*[F.min_by(c, "_key").alias(c) for c in values])


def resample_nearest(
    df: DataFrame,
    src_res: float,
    dst_res: float,
    size: tuple[int, int],
    row: str = "row",
    col: str = "col",
) -> DataFrame:
    """Bring pixels to a grid of another resolution with the same upper-left corner.

    A target pixel takes the source pixel that holds its centre. Each source row
    generates its own target pixels, so there is neither a join nor a shuffle.
    """
    width, height = size
    ratio = src_res / dst_res

    def targets(source: Column, limit: int) -> Column:
        lo = F.greatest(F.ceil(source * ratio - 0.5), F.lit(0)).cast("int")
        hi = F.least(F.ceil((source + 1) * ratio - 0.5) - 1, F.lit(limit - 1)).cast("int")
        return F.when(lo <= hi, F.sequence(lo, F.greatest(lo, hi)))

    kept = [c for c in df.columns if c not in (row, col)]
    rows = df.select(
        *kept, F.col(col).alias("_c"), F.explode(targets(F.col(row), height)).alias(row)
    )
    return rows.select(*kept, row, F.explode(targets(F.col("_c"), width)).alias(col))
