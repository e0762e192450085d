"""Skip work that is already done, and merge the results of several runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.naming import point_name
from fallowlens.schemas import Params

WORK_KEY = ("point", "window_m", "interval")


def with_work_key(seeds: DataFrame, params: Params) -> DataFrame:
    """Key of a seed's extraction: point name, whole window metres, date range."""
    return seeds.withColumns(
        {
            "point": point_name(F.col("lat"), F.col("lon")),
            "window_m": F.lit(int(params.window_m)),
            "interval": F.lit(f"{params.start_date}_{params.end_date}"),
        }
    )


def finished(manifest: DataFrame) -> DataFrame:
    """Keys that have both tiles and a band list."""
    complete = (F.col("n_tiles") > 0) & F.col("bands").isNotNull()
    return manifest.filter(complete).select(*WORK_KEY).distinct()


def skip_done(seeds: DataFrame, manifest: DataFrame, params: Params) -> DataFrame:
    """Seeds still to extract. Seeds at one point share their extraction."""
    keyed = with_work_key(seeds, params)
    return keyed.join(finished(manifest), list(WORK_KEY), "left_anti").select(*seeds.columns)


def merge_runs(*runs: DataFrame) -> DataFrame:
    """Results of several runs, columns aligned by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)
