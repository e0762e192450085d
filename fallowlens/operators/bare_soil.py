"""Bare-soil observations and their per-pixel statistics over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.stats import gather, gathered_stats
from fallowlens.schemas import BANDS, INDICES, STATS


def flag_bare_soil(df: DataFrame, threshold: float) -> DataFrame:
    """``is_baresoil``: NDVI strictly below the threshold, false when missing."""
    return df.withColumn("is_baresoil", F.coalesce(F.col("NDVI") < threshold, F.lit(False)))


def bare_soil_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_baresoil"))


def pixel_statistics(
    bare: DataFrame,
    keys: Sequence[str],
    targets: Sequence[str] = BANDS + INDICES,
    condition: Column | None = None,
) -> DataFrame:
    """Median, mean and sample deviation of each target, and ``n_obs_baresoil``.

    With a ``condition`` only rows meeting it are observations; a pixel without
    any keeps its row and has a NULL count.

    Expects one row per pixel and day (``last_of_day``), so a group holds no more
    rows than the run has days. Deviation of a single observation is NULL.
    """
    gathered = bare.groupBy(*keys).agg(gather(targets, condition).alias("_obs"))
    count = F.nullif(F.size("_obs"), F.lit(0)).cast("long")
    gathered = gathered.withColumn("n_obs_baresoil", count)
    names = [tuple(f"{c}_{s}_bs" for s in STATS) for c in targets]
    stats = gathered_stats(gathered, "_obs", names, ddof=1)
    return stats.select(*keys, *[n for triple in names for n in triple], "n_obs_baresoil")


def mask_min_obs(
    df: DataFrame, min_obs: int, keys: Sequence[str], mask_n_obs: bool = False
) -> DataFrame:
    """NULL out the features of pixels with too few observations; rows stay.

    ``mask_n_obs`` also blanks the count itself, as the single-point form does.
    """
    spared = set(keys) if mask_n_obs else {*keys, "n_obs_baresoil"}
    return df.selectExpr(
        *[
            f"`{c}`" if c in spared else f"if(n_obs_baresoil >= {min_obs}, `{c}`, null) as `{c}`"
            for c in df.columns
        ]
    )
