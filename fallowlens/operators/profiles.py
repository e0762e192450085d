"""Mergeable table profiles: sketches of each part of a table, stored and added up.

``profile_sketches`` reads a table once and leaves one row for each part and column: counts,
extremes, moments, and sketches of the distinct values, the quantiles and the frequent
values, each of bounded size. ``merged_profile`` adds such rows up, of today's part and of
all earlier ones, without reading any of their data again. ``exact_profile`` in
``operators.quality`` is the exact form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Binary logarithm of the distinct sketch's slots: about 0.8 % standard error, 13 kB.
DISTINCT_BITS = 14

#: Items a quantile sketch keeps in its levels: about 0.7 % of the rank.
QUANTILE_SIZE = 400

#: Values that a part counts for the frequent ones.
FREQUENT_ITEMS = 4096

FACTS = ("rows", "held", "low", "high", "low_text", "high_text", "mean", "deviations", "distinct", "quantiles", "frequent")


def _facts(f: T.StructField) -> dict[str, Column]:
    c = F.col(f"`{f.name}`")
    number = isinstance(f.dataType, T.NumericType)
    value = c.cast("double") if number else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if number else c.cast("string")
    name = f"`{f.name}`"
    return {
        "rows": F.count("*"),
        "held": F.count(c),
        "low": F.min(value),
        "high": F.max(value),
        "low_text": F.min(text),
        "high_text": F.max(text),
        "mean": F.avg(value),
        "deviations": F.var_pop(value) * F.count(value),
        "distinct": F.hll_sketch_agg(c.cast("string"), DISTINCT_BITS),
        "quantiles": F.kll_sketch_agg_double(value, QUANTILE_SIZE),
        "frequent": F.expr(f"approx_top_k_accumulate(cast({name} as string), {FREQUENT_ITEMS})"),
    }


def profile_sketches(df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
    """``parts``, ``column, type`` and ``FACTS``: a row for each part of the table and column, from one pass.

    Parts are values of columns, such as the day a row came in; those columns are not
    profiled. A part's sketches are combined on the map side and have a bounded size.
    """
    fields = [f for f in df.schema if f.name not in parts]
    aggs = [a.alias(f"{k}{i}") for i, f in enumerate(fields) for k, a in _facts(f).items()]
    wide = df.groupBy(*parts).agg(*aggs)
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            *[F.col(f"{k}{i}").alias(k) for k in FACTS],
        )
        for i, f in enumerate(fields)
    ])
    return wide.select(*parts, F.inline(rows))


def merged_profile(sketches: DataFrame, k: int = 5, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column: counts, extremes, mean and deviation, and what the merged sketches tell.

    ``rows, nulls, low, high, low_text, high_text, mean, std`` are exact, ``distinct``,
    ``q25`` and the like, and ``top`` (value and count, the most frequent first) are estimates.
    """
    n = F.coalesce(F.col("held"), F.lit(0))
    weighted = F.sum(n * F.coalesce("mean", F.lit(0.0)))
    squares = F.sum(F.coalesce("deviations", F.lit(0.0)) + n * F.coalesce(F.col("mean") * F.col("mean"), F.lit(0.0)))
    merged = sketches.groupBy("column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum(n).alias("held"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        weighted.alias("_sum"),
        squares.alias("_squares"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct", True)).alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("_q"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {FREQUENT_ITEMS}), {k})").alias("top"),
    )
    number = F.col("low").isNotNull()
    mean = F.when(number, F.col("_sum") / F.col("held"))
    spread = F.greatest(F.col("_squares") - F.col("_sum") * F.col("_sum") / F.col("held"), F.lit(0.0))
    return merged.select(
        "column", "type", "rows", (F.col("rows") - F.col("held")).alias("nulls"), "low", "high", "low_text", "high_text",
        mean.alias("mean"), F.when(number & (F.col("held") > 1), F.sqrt(spread / (F.col("held") - 1))).alias("std"), "distinct",
        *[F.when(number, F.kll_sketch_get_quantile_double("_q", F.lit(float(x)))).alias(f"q{round(100 * x)}") for x in quantiles],
        "top",
    )


def add_part(sketches: DataFrame, path: str, parts: Sequence[str]) -> None:
    """Store a part's sketches beside those of others; a part that comes again replaces its own."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*parts).parquet(path)
