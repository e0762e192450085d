"""Seed, survey and result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.operators.quality import require_columns

def number_rows(df: DataFrame, name: str = "position") -> DataFrame:
    """Append the 0-based row position of a frame read straight from files.

    Rows follow the files' paths, then their place in the file, however the scan packs
    files into partitions. A block of a file lies in one partition, so rows are numbered
    inside their block and shifted by the sizes of the blocks before. Only one row per
    block is ever brought together.
    """
    block = ["_file", "_start"]
    marked = df.select(
        *df.columns,
        F.monotonically_increasing_id().alias("_m"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy(*block)
        .agg(F.count("*").alias("_rows"), F.min("_m").alias("_first"))
        .select(*block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # bounded: as many rows as the scan has blocks
    placed = marked.join(F.broadcast(offsets), block)
    return placed.select(*df.columns, (F.col("_offset") + F.col("_m") - F.col("_first")).alias(name))


def with_seed_ids(df: DataFrame) -> DataFrame:
    """Check and type a seed table; number the seeds when they have no id."""
    require_columns(df, ["lat", "lon"])
    if "seed_id" not in df.columns:
        numbered = number_rows(df)
        df = numbered.withColumn("seed_id", F.format_string("seed_%04d", "position")).drop("position")
    return df.select(
        F.col("seed_id").cast("string").alias("seed_id"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
    )


def read_seeds(spark: SparkSession, path: str, has_id: bool = True) -> DataFrame:
    """Seeds from CSV with header: ``[seed_id,] lat, lon`` in any column order."""
    header = spark.read.option("header", True).csv(path)
    names = header.columns
    require_columns(header, ["lat", "lon"])
    kinds = {"lat": T.DoubleType(), "lon": T.DoubleType()}
    schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    typed = spark.read.option("header", True).schema(schema).csv(path)
    return with_seed_ids(typed if has_id else typed.drop("seed_id"))


def read_survey(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Survey rows with ``seq``, their order in the files, which look-ups go by."""
    return number_rows(spark.read.option("header", True).schema(schema).csv(path), "seq")


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Any CSV for profiling; types are inferred by a pass of their own."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_results(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    stored = spark.read.parquet(path)
    return stored.select(*columns) if columns is not None else stored
