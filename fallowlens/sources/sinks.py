"""Writers. Partition columns replace directories per point; files hold many seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.schemas import Params


def _parquet(df: DataFrame, path: str, *partitions: str, mode: str = "overwrite") -> None:
    """Overwriting replaces only the partitions that ``df`` has rows for."""
    writer = df.write.mode(mode)
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def run_partitions(df: DataFrame, params: Params) -> DataFrame:
    """The partition columns of a run: whole window metres and the interval's ends."""
    return df.withColumns({
        "window": F.lit(int(params.window_m)),
        "start_date": F.lit(params.start_date),
        "end_date": F.lit(params.end_date),
    })


def of_run(stored: DataFrame, params: Params) -> DataFrame:
    """The rows of one run, read by its partition only."""
    return stored.filter(
        (F.col("window") == int(params.window_m))
        & (F.col("start_date") == params.start_date)
        & (F.col("end_date") == params.end_date)
    )


def write_timeseries(df: DataFrame, path: str, params: Params, mode: str = "overwrite") -> None:
    """Per-pixel time series, clustered so that a seed lies in few files.

    Ranges over the pixel split a large seed over several tasks and files. Runs of
    other windows or intervals in the same folder stay.
    """
    clustered = df.repartitionByRange("seed_id", "row", "col").sortWithinPartitions(
        "seed_id", "row", "col", "date"
    )
    _parquet(run_partitions(clustered, params), path, "window", "start_date", "end_date", mode=mode)


def write_pixel_features(df: DataFrame, path: str, params: Params, mode: str = "overwrite") -> None:
    """Pixel table of a run, beside those of other windows and intervals."""
    _parquet(run_partitions(df, params), path, "window", "start_date", "end_date", mode=mode)


def write_seed_features(
    df: DataFrame, path: str, processed: DataFrame | None = None, mode: str = "overwrite"
) -> bool:
    """One consolidated table, only if there is any row; tells whether it wrote.

    ``processed`` lists the seeds behind the rows, so that the check need not
    compute the features.
    """
    if (df if processed is None else processed).isEmpty():
        return False
    _parquet(df, path, mode=mode)
    return True


def write_errors(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """CSV of failed seeds, only if there is any."""
    held = df.persist()
    try:
        if held.isEmpty():
            return False
        held.write.mode(mode).option("header", True).csv(path)
        return True
    finally:
        held.unpersist()


def write_survey(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """Parquet first; the CSV is written from it, so the join runs once."""
    _parquet(df, parquet_path)
    stored = df.sparkSession.read.parquet(parquet_path)
    stored.write.mode("overwrite").option("header", True).csv(csv_path)


def write_tiles(tiles: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Per-date tiles with their band order as a column."""
    _parquet(tiles.repartitionByRange("date", "seed_id"), path, "date", mode=mode)


def write_table(df: DataFrame, path: str) -> None:
    """Pixel tables and grids."""
    _parquet(df, path)


def write_mosaic(
    mosaic: DataFrame, path: str, collection: str, aoi: str, name: str, mode: str = "overwrite"
) -> None:
    """Area mosaic under ``collection=/aoi=/mosaic=`` folders."""
    tagged = mosaic.withColumns(
        {"collection": F.lit(collection), "aoi": F.lit(aoi), "mosaic": F.lit(name)}
    )
    _parquet(tagged, path, "collection", "aoi", "mosaic", mode=mode)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, mode: str = "overwrite") -> None:
    """A table of pixels in buckets by seed, sorted by pixel, as the session's table ``table``.

    All rows of a seed lie in one bucket, so that whoever groups or joins them by seed, or by
    seed and pixel, reads them where they lie, without a shuffle. ``buckets`` should keep
    a bucket near 200 MB.
    """
    order = ["seed_id", *[c for c in ("row", "col", "date", "acq_date") if c in df.columns]]
    dealt = df.repartition(buckets, "seed_id")
    writer = dealt.write.mode(mode).bucketBy(buckets, "seed_id").sortBy(*order)
    writer.option("path", path).saveAsTable(table)
