"""From raw documents to a training mixture, in five stages.

Quality rules, near-duplicates, repeated units, benchmark passages, source mixing. Each
stage is a function of (spark, docs, sf_dir); its rows are written and read again as the
next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fallowlens.llm import decontaminate, mixing, near_dedup, quality, repeats
from fallowlens.llm.common import stored
from fallowlens.llm.queries import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their language's cutoffs. Null and empty texts go; an empty table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies; without words or an id a row stays. An empty table stays empty."""
    return near_dedup.keep_one_each(docs, near_dedup.Params(percent=80))


def repeated_units(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; every row stays, null texts as they are."""
    return repeats.remove_repeats(docs, params=repeats.PASSAGES)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null texts hold none. An empty benchmark, or table, changes nothing."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, so that all sources weigh alike; sources without any text go. An empty table stays empty."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_units", repeated_units),
    ("benchmark_passages", benchmark_passages),
    ("source_mixture", source_mixture),
]

#: Near-duplicate components and the latent space have no SQL form; tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
