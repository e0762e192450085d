"""Per-seed statistics over the pixels of its window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.stats import gather, gathered_stats, median_sql
from fallowlens.operators.quantiles import grouped_quantiles
from fallowlens.schemas import STATS

_NOT_FEATURES = {"seed_id", "seed_lat", "seed_lon", "row", "col", "x", "y", "n_obs_baresoil"}


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are neither keys nor counts, in table order."""
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in _NOT_FEATURES
    ]


def seed_statistics(
    pixels: DataFrame,
    min_obs: int,
    size: tuple[int, int] | None = None,
    features: Sequence[str] | None = None,
    spread: bool = False,
    marked: bool = False,
) -> DataFrame:
    """One row per seed: pixel counts, and median, mean and population deviation
    of each feature over the pixels with at least ``min_obs`` observations.

    A pixel whose count is NULL was seen but never bare. It makes its seed appear
    and enters no statistic.

    ``in_grid`` is false for a seed with a pixel outside a declared ``size`` (width,
    height): such a seed fails, like one whose rasters differ in shape. With ``marked``
    a pixel without a place makes it false too.

    A seed's pixels meet in one array, as many as its raster has. ``spread`` finds the
    same statistics without gathering them, for rasters of any size; it reads
    ``pixels`` twice, so hand in a stored table.
    """
    feats = list(features) if features is not None else feature_columns(pixels)
    inside = _inside(size)
    if marked:
        inside = F.col("row").isNotNull() & inside
    valid = inside & (F.col("n_obs_baresoil") >= min_obs)
    counts = [
        F.count("n_obs_baresoil").alias("n_pixels"),
        F.count_if(F.col("n_obs_baresoil") >= min_obs).alias("n_pixels_with_min_obs"),
        F.avg("n_obs_baresoil").alias("mean_n_obs_baresoil"),
        F.bool_and(inside).alias("in_grid"),
    ]
    names = {f: tuple(f"{f}_space_{s}" for s in STATS) for f in feats}
    order = [
        "seed_id",
        "n_pixels",
        "n_pixels_with_min_obs",
        "mean_n_obs_baresoil",
        "median_n_obs_baresoil",
        *[n for triple in names.values() for n in triple],
        "in_grid",
    ]
    if spread:
        return _spread_statistics(pixels, valid, counts, names).select(*order)

    gathered = pixels.groupBy("seed_id").agg(
        *counts,
        gather(feats, valid).alias("_px"),
        F.sort_array(F.collect_list(F.when(inside, F.col("n_obs_baresoil")))).alias("_n"),
    )
    gathered = gathered.withColumn("median_n_obs_baresoil", F.expr(median_sql("_n"))).drop("_n")
    return gathered_stats(gathered, "_px", list(names.values()), ddof=0).select(*order)


def _inside(size: tuple[int, int] | None) -> Column:
    if size is None:
        return F.lit(True)
    width, height = size
    return F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1)


def _spread_statistics(pixels, valid, counts, names) -> DataFrame:
    """The same columns without gathering a seed's pixels anywhere."""
    masked = pixels.select(
        "seed_id",
        "row",
        "col",
        "n_obs_baresoil",
        *[F.when(valid, F.col(f)).alias(f) for f in names],
    )
    moments = masked.groupBy("seed_id").agg(
        *counts,
        *[F.avg(f).alias(mean) for f, (_, mean, _) in names.items()],
        *[F.stddev_pop(f).alias(std) for f, (_, _, std) in names.items()],
    )
    medians = grouped_quantiles(
        masked,
        ["seed_id"],
        {
            "n_obs_baresoil": {"median_n_obs_baresoil": 0.5},
            **{f: {median: 0.5} for f, (median, _, _) in names.items()},
        },
    )
    return moments.join(medians, "seed_id")


def attach_to_seeds(seeds: DataFrame, stats: DataFrame) -> DataFrame:
    """Keep seeds that had data but no bare pixel: zero pixels, no statistics."""
    return seeds.join(stats, "seed_id", "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("n_pixels", "n_pixels_with_min_obs")}
    )


def pixel_coverage(stats: DataFrame, size: tuple[int, int]) -> DataFrame:
    """Share of a seed's grid with enough bare-soil observations."""
    width, height = size
    return stats.withColumn(
        "pixel_coverage", F.col("n_pixels_with_min_obs") / F.lit(float(width * height))
    )

