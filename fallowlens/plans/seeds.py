"""Seed preparation: survey rows with cleaned, looked-up coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.operators.survey import clean_ids, coord_lookup, join_coordinates


def prepare_seeds(values: DataFrame, coords: DataFrame) -> DataFrame:
    """Survey values with ``lat, lon``, and ``seed_id`` as the link to features."""
    joined = join_coordinates(values, coord_lookup(clean_ids(coords)))
    return joined.withColumn("seed_id", F.col("POINT_ID"))
