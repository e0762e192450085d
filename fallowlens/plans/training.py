"""Training table: seed features joined one to one with survey values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.operators.quality import duplicate_keys


def training_table(features: DataFrame, survey: DataFrame) -> DataFrame:
    """Rows whose ``seed_id`` is unique on both sides; see ``training_errors``."""
    lab = survey.drop("lat", "lon")
    return _unique(features).join(_unique(lab), "seed_id")


def training_errors(features: DataFrame, survey: DataFrame) -> DataFrame:
    """Ids that break the one-to-one rule, with the side they occur on."""
    sides = [
        duplicate_keys(df, "seed_id").select("seed_id", F.lit(side).alias("side"), "n_rows")
        for side, df in (("features", features), ("survey", survey))
    ]
    return sides[0].unionByName(sides[1])


def _unique(df: DataFrame) -> DataFrame:
    """Rows whose id occurs once. Counted and carried by one aggregate, whose
    partitioning also serves the join."""
    counted = df.groupBy("seed_id").agg(
        F.count("*").alias("_n"), F.first(F.struct(*df.columns)).alias("_row")
    )
    return counted.filter((F.col("_n") == 1) & F.col("seed_id").isNotNull()).select("_row.*")
