"""Soil-survey tables: id cleaning, coordinate lookup, join and diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.indices import nan_to_null
from fallowlens.operators.quantiles import grouped_quantiles

# Id texts that stand for a missing id.
INVALID_IDS = ("NE", "NAN")


def clean_ids(df: DataFrame, column: str = "POINT_ID") -> DataFrame:
    """Drop rows without a usable id, strip the ``.0`` of float-like ids."""
    text = F.col(column).cast("string")
    valid = text.isNotNull() & ~F.upper(text).isin(*INVALID_IDS)
    return df.filter(valid).withColumn(column, F.regexp_replace(text, r"\.0$", ""))


def coord_lookup(cleaned: DataFrame, order: str = "seq") -> DataFrame:
    """First complete coordinates of each id, in file order."""
    complete = cleaned.select("POINT_ID", "GPS_LAT", "GPS_LONG", order).dropna(
        how="any", subset=["GPS_LAT", "GPS_LONG"]
    )
    return complete.groupBy("POINT_ID").agg(
        F.min_by("GPS_LAT", order).alias("GPS_LAT"),
        F.min_by("GPS_LONG", order).alias("GPS_LONG"),
    )


def join_coordinates(values: DataFrame, lookup: DataFrame) -> DataFrame:
    """Survey rows with ``lat`` and ``lon``, NULL where the id is unknown.

    The lookup grows with the survey, so its join strategy is left to Spark.
    """
    named = values.withColumnRenamed("Point_ID", "POINT_ID").withColumn(
        "POINT_ID", F.col("POINT_ID").cast("string")
    )
    return named.join(lookup, "POINT_ID", "left").withColumnsRenamed(
        {"GPS_LAT": "lat", "GPS_LONG": "lon"}
    )


def id_counts(coords: DataFrame) -> DataFrame:
    """Rows read, rows with a valid id, and ids in the lookup, in one pass."""
    text = F.col("POINT_ID").cast("string")
    valid = text.isNotNull() & ~F.upper(text).isin(*INVALID_IDS)
    located = valid & F.col("GPS_LAT").isNotNull() & F.col("GPS_LONG").isNotNull()
    return coords.agg(
        F.count("*").alias("n_rows"),
        F.count_if(valid).alias("n_valid"),
        F.count_distinct(F.when(located, F.regexp_replace(text, r"\.0$", ""))).alias("n_lookup"),
    )


def latitude_range(lookup: DataFrame) -> DataFrame:
    """Extent of the latitudes; texts that are no numbers are skipped."""
    lat = nan_to_null(F.col("GPS_LAT").try_cast("double"))
    return lookup.agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"))


def missing_coordinates(joined: DataFrame) -> DataFrame:
    return joined.agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("lat").isNull()).alias("n_missing")
    )


def unmatched_head(joined: DataFrame, n: int = 10) -> DataFrame:
    """First ids without coordinates."""
    return joined.filter(F.col("lat").isNull()).select("POINT_ID").orderBy("POINT_ID").limit(n)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Summary of numeric columns, one row each, with exact quartiles.

    Value counts are aggregated before the most frequent value is taken, so no
    task ever holds all the values of a column.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    values = df.select(F.inline(pairs)).filter(F.col("value").isNotNull())
    moments = values.groupBy("column").agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    freq = values.groupBy("column", "value").agg(F.count("*").alias("n"))
    # the most frequent value, the smallest among equals
    top = freq.groupBy("column").agg(
        F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )
    quartiles = grouped_quantiles(
        values, ["column"], {"value": {"q25": 0.25, "q50": 0.5, "q75": 0.75}}, gathered=0
    )
    return (
        moments.join(top, "column")
        .join(quartiles, "column")
        .select(
            "column", "count", "unique", "top", "freq", "mean", "std", "min",
            "q25", "q50", "q75", "max",
        )
    )


def describe_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Summary of columns as texts, one row each: ``count, unique, top, freq``.

    ``top`` is the most frequent value, the smallest among equals. Values are counted
    before anything is compared, with combining on the map side; a column without any value
    has no top.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])
    freq = df.select(F.inline(pairs)).groupBy("column", "value").agg(F.count("value").alias("n"))
    # fewer rows than values: more occurrences sort first, then the smaller value
    return freq.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count("value").alias("unique"),
        F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("less"), "value"))).alias("best"),
    ).select("column", "count", "unique", F.col("best.value").alias("top"), (-F.col("best.less")).alias("freq"))
