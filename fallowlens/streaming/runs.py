"""Runs that become visible at once, and what they leave to do.

A run writes its tables under its own number, with an outcome for every seed: features or
an error. It is published by one row of the manifest, which names its window, interval and
all parameters; until then no reader sees it. Of all published runs of a window and
interval, the last one that had a seed owns it: series, pixels, features and error of a
seed always come from the same run. Runs of other windows or intervals stand beside it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.naming import point_name
from fallowlens.schemas import BANDS, ERRORS, Params, pixel_schema, seed_schema, timeseries_schema
from fallowlens.sources import folders

MANIFEST = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("published_ns", T.LongType()),
    T.StructField("window", T.IntegerType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("params", T.StringType()),
    T.StructField("n_features", T.LongType()),
    T.StructField("n_errors", T.LongType()),
])

OUTCOMES = T.StructType([*ERRORS.fields, T.StructField("point", T.StringType())])

#: Partition columns of the tables that are larger than one row a seed.
_PLACED = [T.StructField("window", T.IntegerType()), T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType())]


def table_schema(table: str, bands: Sequence[str] = BANDS) -> T.StructType:
    """The columns of a run's table. ``errors`` are the outcomes that name one."""
    if table == "pixel_timeseries":
        return T.StructType(timeseries_schema(bands).fields + _PLACED)
    if table == "pixel_features":
        return T.StructType(pixel_schema(bands).fields + _PLACED)
    if table == "seed_features":
        return seed_schema(bands)
    if table in ("outcomes", "errors"):
        return OUTCOMES if table == "outcomes" else ERRORS
    raise ValueError(f"no table {table}")


def params_text(params: Params) -> str:
    return json.dumps(asdict(params), sort_keys=True)


@dataclass(frozen=True)
class Run:
    """A run that is being written."""

    out: str
    run_id: str
    params: Params

    def path(self, table: str) -> str:
        return f"{self.out}/{table}/run_id={self.run_id}"

    def stored(self, spark: SparkSession, table: str) -> DataFrame:
        """What this run wrote; no row if it wrote none."""
        return _read(spark, self.path(table), table_schema(table, self.params.bands))


def start(out: str, params: Params) -> Run:
    return Run(out, uuid.uuid4().hex, params)


def outcomes(features: DataFrame, errors: DataFrame) -> DataFrame:
    """A row for every seed: its error, or none where it has features."""
    done = features.select("seed_id", "lat", "lon", F.lit(None).cast("string").alias("error"))
    rows = done.unionByName(errors.select("seed_id", "lat", "lon", "error"))
    return rows.withColumn("point", point_name(F.col("lat"), F.col("lon")))


def publish(spark: SparkSession, run: Run) -> None:
    """Make the run visible: one row, in one file, after everything else is stored."""
    counts = run.stored(spark, "outcomes").agg(
        F.count_if(F.col("error").isNull()).alias("done"), F.count("error").alias("failed")
    ).first()
    p = run.params
    row = (run.run_id, time.time_ns(), int(p.window_m), p.start_date, p.end_date, params_text(p), counts["done"], counts["failed"])
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{run.out}/manifest")


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not folders.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, f"{out}/manifest", MANIFEST)


def _published(spark: SparkSession, out: str) -> list[Row]:
    """The manifest in the order of publishing: a row for each run, not for its data."""
    return manifest(spark, out).orderBy("published_ns", "run_id").collect()


def _of_runs(spark: SparkSession, out: str, table: str, runs: Sequence[Row], bands: Sequence[str]) -> DataFrame:
    """A table's rows of these runs; only their folders are read."""
    schema = T.StructType([*table_schema(table, bands).fields, T.StructField("run_id", T.StringType())])
    return _read(spark, f"{out}/{table}", schema).filter(F.col("run_id").isin([r.run_id for r in runs]))


def owners(spark: SparkSession, out: str, runs: Sequence[Row] | None = None) -> DataFrame:
    """(seed_id, run_id): the run that owns each seed, for every window and interval.

    The last published run is found by its number in a hash aggregate, combined on the map side.
    """
    runs = _published(spark, out) if runs is None else runs
    numbered = spark.createDataFrame(
        [(r.run_id, k, r.window, r.start_date, r.end_date) for k, r in enumerate(runs)],
        "run_id string, number int, window int, start_date string, end_date string",
    )
    had = _of_runs(spark, out, "outcomes", runs, BANDS).select("seed_id", "run_id").join(numbered, "run_id")
    last = had.groupBy("seed_id", "window", "start_date", "end_date").agg(F.max("number").alias("number"))
    return last.join(numbered.select("number", "run_id"), "number").select("seed_id", "run_id")


def published(spark: SparkSession, out: str, table: str, bands: Sequence[str] = BANDS) -> DataFrame:
    """The rows of ``table`` that the owning runs of their seeds wrote, with the table's own columns."""
    runs = _published(spark, out)
    own = owners(spark, out, runs)
    if table == "errors":
        rows = _of_runs(spark, out, "outcomes", runs, bands).filter(F.col("error").isNotNull())
    else:
        rows = _of_runs(spark, out, table, runs, bands)
    return rows.join(own, ["seed_id", "run_id"], "left_semi").select(*table_schema(table, bands).names)


def pending(seeds: DataFrame, out: str, params: Params) -> DataFrame:
    """Seeds that no owning run with all the same parameters has finished at their point.

    A seed that failed, whose point moved, or that ran with other parameters is to do.
    """
    spark = seeds.sparkSession
    runs = _published(spark, out)
    same = [r for r in runs if r.params == params_text(params)]
    done = _of_runs(spark, out, "outcomes", same, params.bands).filter(F.col("error").isNull())
    done = done.join(owners(spark, out, runs), ["seed_id", "run_id"], "left_semi").select("seed_id", "point").distinct()
    keyed = seeds.withColumn("point", point_name(F.col("lat"), F.col("lon")))
    return keyed.join(done, ["seed_id", "point"], "left_anti").select(*seeds.columns)


def remove_superseded(spark: SparkSession, out: str) -> list[str]:
    """Delete the tables of published runs that own no seed any more; names them.

    Runs that are not published may still be at work and are left alone.
    """
    runs = _published(spark, out)
    live = {r["run_id"] for r in owners(spark, out, runs).select("run_id").distinct().collect()}
    gone = [r.run_id for r in runs if r.run_id not in live]
    for run_id in gone:
        for table in ("pixel_timeseries", "pixel_features", "seed_features", "errors", "outcomes"):
            folders.remove(spark, f"{out}/{table}/run_id={run_id}")
    return gone
