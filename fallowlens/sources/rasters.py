"""Raster files: discovery, dates from file names, decoding in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.functions.naming import point_name
from fallowlens.operators.tiles import in_interval
from fallowlens.schemas import TILES

# Fixed value: acquisition day in front of the extension, e.g. 2024-06-01.tif
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})\.[^.]+$"

# Fixed value: folder of a survey point above its files
POINT_IN_PATH = r"/(point_[^/]+)/"

RASTERS = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("date", T.DateType())]
    + [TILES[f] for f in ("width", "height", "transform", "bands", "data")]
    + [T.StructField("error", T.StringType()), T.StructField("epsg", T.IntegerType())]
)


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", "true").load(path)


def file_date(path: str = "path"):
    """Day in a file name; NULL when it names none, or none that exists."""
    return F.regexp_extract(path, DATE_IN_NAME, 1).try_cast("date")


def discover(spark: SparkSession, path: str, glob: str = "*.tif") -> DataFrame:
    """Files below a folder with size and day; contents are not read."""
    return _files(spark, path, glob).select("path", "length", file_date().alias("date"))


def first_file(files: DataFrame) -> DataFrame:
    return files.orderBy("path").limit(1)


def read_rasters(
    spark: SparkSession,
    path: str,
    decoder: Callable[[bytes], dict],
    glob: str = "*.tif",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Decode each file into a tile row.

    ``decoder`` turns file contents into ``width, height, transform, bands`` and
    ``data`` (flat, band-major), and ``epsg`` if it knows the coordinate system. It runs in
    the tasks, one file at a time. A file it fails on keeps its row: no raster, and what
    went wrong as ``error``. Files named after a day before ``start`` or after ``end``
    are left out by their names, while files are listed; they are never opened.
    """
    empty = dict.fromkeys(("width", "height", "transform", "bands", "data", "epsg"))

    def decoded(content: bytes) -> dict:
        try:
            return {"epsg": None, **decoder(content), "error": None}
        except Exception as e:
            return {**empty, "error": f"{type(e).__name__}: {e}"}

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, date, content in zip(batch["path"], batch["date"], batch["content"]):
                yield pd.DataFrame([{"path": path, "date": date, **decoded(content)}], dtype=object)[
                    RASTERS.fieldNames()
                ]

    files = _files(spark, path, glob)
    # a condition on the file's own metadata is met by the listing, before any task
    named = file_date("_metadata.file_name")
    files = files.filter(named.isNull() | in_interval(named, start, end))
    return files.select("path", file_date().alias("date"), "content").mapInPandas(decode, RASTERS)


STRIPS = T.StructType(RASTERS.fields + [T.StructField("row0", T.IntegerType())])


def read_strips(
    spark: SparkSession,
    path: str,
    decoder: Callable[[bytes], Iterator[dict]],
    glob: str = "*.tif",
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Decode each file into rows of a few raster lines, see ``operators.tiles.strips``.

    ``decoder`` yields strips one after another: ``width, transform, bands, row0``, the
    number of lines as ``height``, and their ``data``; a raster of any size so never is one
    array. A stack of several acquisitions may add the ``date`` of each strip. A file that
    fails gives one row with its ``error`` after the strips that were read.
    """
    fields = [f.name for f in STRIPS if f.name not in ("path", "date", "error")]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, date, content in zip(batch["path"], batch["date"], batch["content"]):
                row = {"path": path, "date": date, "error": None, **dict.fromkeys(fields)}
                try:
                    for strip in decoder(content):
                        yield pd.DataFrame([{**row, **strip}], dtype=object)[STRIPS.fieldNames()]
                except Exception as e:
                    failed = {**row, "error": f"{type(e).__name__}: {e}"}
                    yield pd.DataFrame([failed], dtype=object)[STRIPS.fieldNames()]

    files = _files(spark, path, glob)
    named = file_date("_metadata.file_name")
    files = files.filter(named.isNull() | in_interval(named, start, end))
    return files.select("path", file_date().alias("date"), "content").mapInPandas(decode, STRIPS)


def attach_seeds(rasters: DataFrame, seeds: DataFrame) -> DataFrame:
    """Give each raster the ``seed_id`` of the points its folder is named after.

    Seeds at one point share the files and get a row each.
    """
    named = rasters.withColumn("_point", F.regexp_extract("path", POINT_IN_PATH, 1))
    points = seeds.select("seed_id", point_name(F.col("lat"), F.col("lon")).alias("_point"))
    return named.join(points, "_point").select("seed_id", *rasters.columns)
