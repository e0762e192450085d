"""Checks, per-seed error quarantine and table profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.operators.quantiles import grouped_quantiles
from fallowlens.operators.tiles import band_count_ok, dates_ok, with_dates
from fallowlens.schemas import BANDS

# Reasons in the order a run meets them: the first one that applies is reported.
REASONS = (
    "missing coordinates",
    "duplicate seed_id",
    "duplicate stack",
    "acquisition dates missing",
    "band count mismatch",
    "corrupt raster",
    "bands missing",
    "scene order missing",
    "no tiles",
    "shape mismatch",
)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def require_bands(bands: Sequence[str]) -> None:
    """All six bands are needed, since every index is computed."""
    missing = [b for b in BANDS if b not in bands]
    if missing:
        raise ValueError(f"missing bands: {missing}")


def fault_rows(ids: DataFrame, reason: str) -> DataFrame:
    return ids.select("seed_id", F.lit(REASONS.index(reason)).alias("reason"))


def coordinate_errors(seeds: DataFrame) -> DataFrame:
    return fault_rows(seeds.filter(F.col("lat").isNull() | F.col("lon").isNull()), "missing coordinates")


def duplicate_errors(seeds: DataFrame) -> DataFrame:
    counted = seeds.groupBy("seed_id").agg(F.count("*").alias("n"))
    return fault_rows(counted.filter(F.col("n") > 1), "duplicate seed_id")


def duplicate_stack_errors(stacked: DataFrame) -> DataFrame:
    return fault_rows(duplicate_keys(stacked, "seed_id"), "duplicate stack")


def stack_errors(stacked: DataFrame, n_bands: int) -> DataFrame:
    """Stacks without dates or with a raster count other than dates x bands."""
    dated = with_dates(stacked)
    return fault_rows(dated.filter(~dates_ok()), "acquisition dates missing").unionByName(
        fault_rows(dated.filter(dates_ok() & ~band_count_ok(n_bands)), "band count mismatch")
    )


def raster_errors(tiles: DataFrame) -> DataFrame:
    """Seeds with a file that could not be decoded, or whose name holds no date."""
    bad = F.col("error").isNotNull() | F.col("date").isNull()
    return fault_rows(tiles.filter(bad), "corrupt raster")


def band_errors(tiles: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Seeds with a tile that lacks a band."""
    wanted = F.array(*[F.lit(b) for b in bands])
    lacking = F.coalesce(F.size(F.array_except(wanted, "bands")) > 0, F.lit(True))
    return fault_rows(tiles.filter(lacking), "bands missing")


def observation_errors(seeds: DataFrame, observed: DataFrame) -> DataFrame:
    """Seeds without observations, or with one whose place among its day's acquisitions
    is unknown (``unordered``). Both come from one pass over the observations."""
    found = seeds.select("seed_id").join(observed.select("seed_id", "unordered"), "seed_id", "left")
    reason = F.when(F.col("unordered").isNull(), REASONS.index("no tiles")).when(
        F.col("unordered"), REASONS.index("scene order missing")
    )
    return found.select("seed_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def missing_errors(seeds: DataFrame, data: DataFrame) -> DataFrame:
    """Seeds without any row in ``data``."""
    present = data.select("seed_id").distinct()
    return fault_rows(seeds.join(present, "seed_id", "left_anti"), "no tiles")


def shape_errors(tiles: DataFrame, with_data: bool = True) -> DataFrame:
    """Seeds whose tiles differ in bands, height or width.

    ``with_data`` also compares each raster's length with its shape, for which
    the rasters have to be read.
    """
    n = F.size("bands")
    mixed = [F.min(c) != F.max(c) for c in (F.col("width"), F.col("height"), n)]
    if with_data:
        mixed.append(F.bool_or(F.size("data") != n * F.col("width") * F.col("height")))
    shaped = tiles.groupBy("seed_id").agg(reduce(lambda a, b: a | b, mixed).alias("mixed"))
    return fault_rows(shaped.filter(F.col("mixed")), "shape mismatch")


def grid_errors(stats: DataFrame) -> DataFrame:
    """Seeds with pixels outside the declared grid, see ``seed_statistics``."""
    return fault_rows(stats.filter(~F.col("in_grid")), "shape mismatch")


def error_table(seeds: DataFrame, found: Sequence[DataFrame]) -> DataFrame:
    """``seed_id, lat, lon, error`` with each failing seed's first reason."""
    first = (
        reduce(DataFrame.unionByName, found)
        .groupBy("seed_id")
        .agg(F.min("reason").alias("reason"))
    )
    text = F.element_at(F.array(*[F.lit(r) for r in REASONS]), F.col("reason") + 1)
    return seeds.select("seed_id", "lat", "lon").join(
        first.select("seed_id", text.alias("error")), "seed_id"
    )


def unique_points(seeds: DataFrame) -> DataFrame:
    """Seeds listed once, or with equal rows: those that no join can multiply."""
    first = F.first(F.struct(*seeds.columns)).alias("_s")
    listed = seeds.distinct().groupBy("seed_id").agg(F.count("*").alias("_n"), first)
    return listed.filter(F.col("_n") == 1).select("_s.*")


def without_errors(df: DataFrame, errors: DataFrame) -> DataFrame:
    return df.join(errors.select("seed_id").distinct(), "seed_id", "left_anti")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def table_profile(df: DataFrame, approximate: bool = True) -> DataFrame:
    """One row per column: counts, extremes and, for numbers, moments.

    A single pass over the table. With ``approximate`` distinct counts and
    medians come from bounded sketches.
    """
    aggs: list[Column] = [F.count("*").alias("n_rows")]
    for i, f in enumerate(df.schema):
        c = F.col(f"`{f.name}`")
        num = c.cast("double") if isinstance(f.dataType, T.NumericType) else None
        none = F.lit(None).cast("double")
        facts = {
            "nulls": F.count_if(c.isNull()),
            "low": F.min(c).cast("string"),
            "high": F.max(c).cast("string"),
            "mean": none if num is None else F.avg(num),
            "std": none if num is None else F.stddev_samp(num),
        }
        if num is not None:
            facts |= {"low": F.min(num).cast("string"), "high": F.max(num).cast("string")}
        if approximate:
            facts |= {
                "distinct": F.approx_count_distinct(c),
                "median": none if num is None else F.percentile_approx(num, 0.5),
            }
        aggs += [a.alias(f"{k}{i}") for k, a in facts.items()]
    wide = df.agg(*aggs)
    names = ["nulls", "low", "high", "mean", "std"]
    if approximate:
        names += ["distinct", "median"]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("n_rows"),
                *[F.col(f"{k}{i}").alias(k) for k in names],
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return wide.select(F.inline(rows))


def exact_profile(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``column, distinct, median`` of every column, exactly.

    Values are counted before anything is gathered, so that each task holds a part of
    the distinct values. Medians are those of the numbers: of columns with up to ``most``
    distinct values they come from the counts, of others from ``grouped_quantiles``, which
    reads those columns alone. The numbers of distinct values, one a column, are taken first.
    """
    numeric = lambda f: isinstance(f.dataType, T.NumericType)

    def values_of(fields: list[T.StructField]) -> DataFrame:
        return df.select(F.inline(F.array(*[
            F.struct(
                F.lit(f.name).alias("column"),
                F.col(f"`{f.name}`").cast("string").alias("text"),
                (F.col(f"`{f.name}`") if numeric(f) else F.lit(None)).cast("double").alias("number"),
            )
            for f in fields
        ])))

    counted = values_of(list(df.schema)).groupBy("column", "text", "number").agg(F.count("*").alias("n"))
    distinct = counted.groupBy("column").agg(F.count("text").alias("distinct"))
    found = [(r["column"], r["distinct"]) for r in distinct.collect()]
    facts = df.sparkSession.createDataFrame(found, "column string, distinct long")
    large = [f for f in df.schema if numeric(f) and dict(found).get(f.name, 0) > most]
    small = [f for f in df.schema if f not in large]
    medians = []
    if small:
        own = values_of(small).groupBy("column", "text", "number").agg(F.count("*").alias("n"))
        medians.append(own.groupBy("column").agg(F.expr("percentile(number, 0.5, n)").alias("median")))
    if large:
        medians.append(grouped_quantiles(values_of(large), ["column"], {"number": {"median": 0.5}}, gathered=0))
    return facts.join(reduce(DataFrame.unionByName, medians), "column")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; smaller values first among equals."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("value")).limit(k)
