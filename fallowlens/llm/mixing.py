"""Mixing sources to target weights by Poisson replication.

A source's rate is its target share of the bytes put out over its share of the bytes
read. A document's copies follow a Poisson distribution with that mean: a uniform
number made from a hash of the seed and the document is looked up in the source's
cumulative probabilities. The copies are then dealt by a hash, so they end up in
random order over all partitions. Only built-in functions are used. Rates have no bound.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fallowlens.llm.common import maybe_broadcast, stored

#: Hexadecimal digits of a hash that make a uniform number, and their range.
DIGITS, RANGE = 13, 16**13


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts' texts; null counts as ``~``."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(RANGE))


def with_cumulative(per_source: DataFrame) -> DataFrame:
    """(source, rate, first, cdf): P(X <= first), P(X <= first + 1), ... of a Poisson variable of each positive rate.

    ``first`` is 0 or 12 deviations and 20 below the rate, and the last entry, 1, as far above it; less than 1e-12
    lies outside. Chances are summed in logarithms from ``first`` on, since exp(-rate) is 0 in doubles above 745, and
    divided by their sum. A table has about ``24 sqrt(rate)`` entries.
    """
    rate, reach = F.col("rate"), 12 * F.sqrt("rate") + 20
    terms = per_source.where("rate > 0").withColumn("first", F.greatest(F.lit(0), F.floor(rate - reach)).cast("int"))
    terms = terms.withColumn("k", F.explode(F.sequence("first", F.ceil(rate + reach).cast("int"))))
    every = Window.partitionBy("source")
    upto = every.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    terms = (
        terms.withColumn("log", F.sum(F.when(F.col("k") > F.col("first"), F.log(rate / F.col("k"))).otherwise(0.0)).over(upto))
        .withColumn("log", F.col("log") - F.max("log").over(every))
        .withColumn("c", F.sum(F.exp("log")).over(upto))
    )
    return terms.groupBy("source", "rate", "first").agg(
        F.transform(F.sort_array(F.collect_list("c")), lambda c: c / F.max("c")).alias("cdf")
    )


def rates(docs: DataFrame, source: str, text: str, weights: Mapping[str, float] | None, total: float) -> DataFrame:
    """(source, rate, first, cdf), a row per source with copies; null is a source of its own.

    ``weights`` are relative targets by source, 0 for a source they leave out; without
    them all sources weigh alike. ``total`` is the output's bytes over the input's.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).alias("bytes")
    )
    if weights is None:
        weight = F.when(F.col("bytes") > 0, F.lit(1.0)).otherwise(0.0)
    else:
        table = F.create_map(*(F.lit(x) for k, v in weights.items() for x in (k, float(v))))
        weight = F.coalesce(F.element_at(table, F.col("source").cast("string")), F.lit(0.0))
        weight = F.when(F.col("bytes") > 0, weight).otherwise(0.0)
    sizes = stored(sizes.withColumn("weight", weight), "mixing-sizes")
    whole = sizes.agg(F.sum("weight").alias("all_weight"), F.sum("bytes").alias("all_bytes"))
    rate = F.when(
        (F.col("bytes") > 0) & (F.col("all_weight") > 0),
        F.col("weight") / F.col("all_weight") * F.lit(float(total)) * F.col("all_bytes") / F.col("bytes"),
    ).otherwise(0.0)
    return stored(
        with_cumulative(sizes.join(F.broadcast(whole)).select("source", rate.alias("rate"))), "mixing-rates"
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    total: float = 1.0,
    seed: int = 0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Documents replicated to target weights, in globally random order.

    The input's columns, whatever their names, follow unchanged, with ``copy`` (0, 1,
    ...) as the last one; an input column of that name is replaced. The result depends
    only on the rows and the seed. A null source is a source of its own; rows with equal
    ids (a null id included) draw alike, so repeated rows are repeated alike. A source
    whose texts are all null or empty has no bytes to weigh and is left out. An empty
    table gives an empty result. Texts of any length are copied whole.
    """
    per_source = maybe_broadcast(rates(docs, source, text, weights, total))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "copy")).alias("row")
    draw = uniform(F.lit(seed), F.col(doc_id))
    packed = docs.select(row, F.col(source).alias("own_source"), draw.alias("draw"))
    copies = F.col("first") + F.size(F.filter("cdf", lambda c: c <= F.col("draw")))
    copied = (
        packed.join(per_source, packed["own_source"].eqNullSafe(per_source["source"]))
        .withColumn("copies", copies)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        # the text counts too, so that texts without an id, or with one id, do not meet in one place
        .withColumn("place", F.xxhash64(F.lit(seed), F.lit("place"), F.col(f"row.`{doc_id}`"), F.col(f"row.`{text}`"), "copy"))
    )
    return copied.repartition("place").sortWithinPartitions("place").select("row.*", "copy")
