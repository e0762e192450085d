"""Raster tiles as rows: unstacking, exploding to pixels, shape facts.

A tile row carries its whole raster as one band-major, row-major float array.
All operators but the per-seed checks work inside a row and need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.geo import pixel_centre
from fallowlens.functions.indices import nan_to_null


def acquisition_dates(userdata: Column) -> Column:
    """Days of the doubly encoded ``acquisition_dates`` list; NULL for a stamp that is no date."""
    stamps = F.from_json(F.get_json_object(userdata, "$.acquisition_dates"), "array<string>")
    return F.transform(stamps, lambda s: F.substring(s, 1, 10).try_cast("date"))


def band_order(metadata: Column) -> Column:
    """Band names of ``{"bands": [...]}``."""
    return F.from_json(metadata, "struct<bands:array<string>>")["bands"]


def with_dates(stacked: DataFrame) -> DataFrame:
    return stacked.withColumn("dates", acquisition_dates(F.col("userdata")))


def band_count_ok(n_bands: int) -> Column:
    """Whether a stack holds dates x bands rasters of its own shape."""
    expected = F.size("dates") * n_bands * F.col("width") * F.col("height")
    return F.coalesce(F.size("data") == expected, F.lit(False))


def dates_ok() -> Column:
    """Whether a stack names its dates, and all of them are dates."""
    return F.coalesce((F.size("dates") > 0) & ~F.exists("dates", lambda d: d.isNull()), F.lit(False))


def in_interval(d: Column, start: str | None, end: str | None) -> Column:
    after = F.lit(True) if start is None else d >= F.lit(start).cast("date")
    return after if end is None else after & (d <= F.lit(end).cast("date"))


def _with_winners(stacked: DataFrame, n_bands: int, start: str | None, end: str | None) -> DataFrame:
    """Sound stacks with ``_w``: date and number of each day's last acquisition in the interval."""
    last = lambda d: F.size("dates") - F.array_position(F.reverse("dates"), d)
    numbered = F.transform("dates", lambda d, i: F.struct(d.alias("date"), i.alias("i")))
    winners = F.filter(numbered, lambda s: (last(s["date"]) == s["i"]) & in_interval(s["date"], start, end))
    sound = with_dates(stacked).filter(dates_ok() & band_count_ok(n_bands))
    return sound.select("seed_id", "width", "height", "transform", "data", winners.alias("_w"))


def unstack_dates(
    stacked: DataFrame, bands: Sequence[str], start: str | None = None, end: str | None = None
) -> DataFrame:
    """One tile per seed and day; the last acquisition of a day wins.

    Date ``i`` owns rasters ``[i * n, i * n + n)``. Days outside ``start`` to ``end``
    are not taken. Rows failing the date or band-count check are left out here and
    reported by ``quality.stack_errors``; a direct caller should run it too.
    """
    shape = ["width", "height", "transform"]
    values = len(bands) * F.col("width") * F.col("height")
    # `slice` stays outside lambdas: there it would copy the whole array each time
    dated = _with_winners(stacked, len(bands), start, end).select("seed_id", *shape, "data", F.inline("_w"))
    return dated.select(
        "seed_id",
        "date",
        *shape,
        F.array(*[F.lit(b) for b in bands]).alias("bands"),
        F.slice("data", F.col("i") * values + 1, values).alias("data"),
    )


def last_of_day_tiles(tiles: DataFrame, order: str = "scene_idx") -> DataFrame:
    """Keep the highest scene of each seed and day, without aggregating rasters."""
    winners = tiles.groupBy("seed_id", "date").agg(F.max(order).alias(order))
    return tiles.join(winners, ["seed_id", "date", order], "left_semi")


def with_first_transform(tiles: DataFrame, most: int = 500_000) -> DataFrame:
    """Use the geometry of a seed's earliest tile for all its dates.

    The geometries of up to ``most`` seeds, some 60 bytes each, are broadcast, so that no
    raster is shuffled; they are counted first, by their ids alone. Those of more seeds are
    joined by a shuffle.
    """
    first = tiles.groupBy("seed_id").agg(F.min_by("transform", "date").alias("transform"))
    few = tiles.select("seed_id").distinct().limit(most + 1).count() <= most
    return tiles.drop("transform").join(F.broadcast(first) if few else first, "seed_id").select(*tiles.columns)


def strips(tiles: DataFrame, most: int) -> DataFrame:
    """Tiles as rows of whole raster lines, each with about ``most`` values of all bands at most.

    ``row0`` is a strip's first line, ``height`` its number of lines. A stack of any number
    of dates and any area so never is one array; a reader may hand in strips to begin with.
    """
    plane = F.col("width") * F.col("height")
    lines = F.greatest(F.lit(1), F.floor(F.lit(most) / (F.size("bands") * F.col("width")))).cast("int")
    cut = tiles.withColumn("_lines", lines).withColumn(
        "row0", F.explode(F.when(F.col("height") > 0, F.sequence(F.lit(0), F.col("height") - 1, F.col("_lines"))))
    )
    held = F.greatest(F.lit(0), F.least(F.col("_lines"), F.col("height") - F.col("row0")))
    band = lambda i: F.slice(F.col("data"), i * plane + F.col("row0") * F.col("width") + 1, held * F.col("width"))
    data = F.flatten(F.transform(F.sequence(F.lit(0), F.size("bands") - 1), band))
    kept = [c for c in tiles.columns if c not in ("height", "data")]
    made = cut.select(*kept, "row0", held.alias("_held"), F.when(raster_whole(), data).alias("data"))
    return made.withColumnRenamed("_held", "height")


def strip_errors(strips: DataFrame, heights: DataFrame) -> DataFrame:
    """Seeds and days whose strips do not make up their raster: gaps, overlaps, or arrays of a wrong length.

    ``heights`` has ``seed_id, date, height`` of the whole rasters. Only the shapes are
    aggregated; values stay where they are.
    """
    per_day = strips.groupBy("seed_id", "date").agg(
        F.sum("height").alias("_lines"), F.count_distinct("row0").alias("_starts"), F.count("*").alias("_n"),
        F.max(F.col("row0") + F.col("height")).alias("_end"), F.bool_and(raster_whole()).alias("_whole"),
    )
    met = heights.join(per_day, ["seed_id", "date"], "left")
    sound = F.col("_whole") & (F.col("_lines") == F.col("height")) & (F.col("_end") == F.col("height")) & (F.col("_starts") == F.col("_n"))
    return met.filter(~F.coalesce(sound, F.lit(False))).select("seed_id", "date")


def raster_whole() -> Column:
    """Whether a tile's array holds all values of its bands and shape."""
    return F.coalesce(F.size("data") == F.size("bands") * F.col("width") * F.col("height"), F.lit(False))


def explode_pixels(
    tiles: DataFrame, bands: Sequence[str], by_name: bool = False, marked: bool = False
) -> DataFrame:
    """One row per pixel: every other column, ``row, col, x, y`` and the bands.

    Bands go by position, and a shorter list takes a prefix. ``by_name`` looks
    each one up in the tile's own ``bands`` column instead. With ``marked`` a tile
    whose array is too short or too long gives one row without place and values, which
    tells of the fault; the array is read here anyway. Strips, which have a ``row0``,
    give the pixels of their lines.
    """
    plane = F.col("width") * F.col("height")
    if by_name:
        starts = [(F.array_position("bands", b) - 1).cast("int") * plane for b in bands]
        starts = [F.when(at >= 0, at) for at in starts]
    else:
        starts = [i * plane for i in range(len(bands))]
    striped = "row0" in tiles.columns
    kept = [c for c in tiles.columns if c not in ("data", "bands", "width", "height", "transform", "row0")]
    first = ["row0"] if striped else []
    # as many places as the longest band has values
    ends = [F.least(F.size("data") - F.coalesce(at, F.size("data")), plane) for at in starts]
    longest = F.when(F.col("data").isNotNull(), F.greatest(*ends, F.lit(0)))
    places = F.when(longest > 0, F.sequence(F.lit(0), longest - 1))
    if marked:
        places = F.when(raster_whole(), places).otherwise(F.array(F.lit(None).cast("int")))
    # places and starts are found in a projection of their own: beside `explode` they would be found
    # again for each pixel, and as often as a filter on the bands names them
    listed = tiles.select(
        *kept, *first, "width", "transform", "data", plane.alias("_plane"),
        *[at.alias(f"_at{i}") for i, at in enumerate(starts)], places.alias("_places"),
    )
    held = listed.select(*[c for c in listed.columns if c != "_places"], F.explode("_places").alias("_pos"))
    # read from the raster in the stage that lists the places, without a copy of a band
    value = lambda i: F.when(F.col("_pos") < F.col("_plane"), F.get("data", F.col(f"_at{i}") + F.col("_pos")))
    flat = held.select(
        *kept, *first, "width", "transform", "_pos", *[value(i).alias(f"_px{i}") for i in range(len(bands))]
    )
    row = F.floor(F.col("_pos") / F.col("width")).cast("int")
    if striped:
        row = row + F.col("row0")
    col = (F.col("_pos") % F.col("width")).cast("int")
    values = [f"_px{i}" for i in range(len(bands))]
    placed = flat.select(*kept, "transform", row.alias("row"), col.alias("col"), *values)
    x, y = pixel_centre(F.col("transform"), F.col("row"), F.col("col"))
    return placed.select(
        *kept,
        "row",
        "col",
        x.alias("x"),
        y.alias("y"),
        *[nan_to_null(F.col(f"_px{i}")).alias(b) for i, b in enumerate(bands)],
    )


def centre_pixel(tiles: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Band values and position of the middle pixel, read straight from the array."""
    row = F.floor(F.col("height") / 2).cast("int")
    col = F.floor(F.col("width") / 2).cast("int")
    plane = F.col("width") * F.col("height")
    x, y = pixel_centre(F.col("transform"), row, col)
    values = [
        nan_to_null(F.get("data", i * plane + row * F.col("width") + col)).alias(b)
        for i, b in enumerate(bands)
    ]
    kept = [c for c in tiles.columns if c in ("seed_id", "date", "path")]
    return tiles.select(
        *kept, row.alias("row"), col.alias("col"), x.alias("x"), y.alias("y"), *values
    )


def raster_min_max(tiles: DataFrame) -> DataFrame:
    """Smallest and largest value over all rasters and bands."""
    clean = F.filter("data", lambda v: ~F.isnan(v))
    return tiles.agg(
        F.min(F.array_min(clean)).cast("double").alias("min_value"),
        F.max(F.array_max(clean)).cast("double").alias("max_value"),
    )


def stack_dimensions(tiles: DataFrame) -> DataFrame:
    """Dates, bands, height and width of each seed's stack, and its first tile's corner."""
    first = F.min_by("transform", "date")
    return tiles.groupBy("seed_id").agg(
        F.count_distinct("date").alias("n_dates"),
        F.max(F.size("bands")).alias("n_bands"),
        F.max("height").alias("height"),
        F.max("width").alias("width"),
        F.get(first, F.lit(2)).alias("x0"),
        F.get(first, F.lit(5)).alias("y0"),
    )


def stack_geometry(tiles: DataFrame) -> DataFrame:
    """Each seed's stack by its first tile: coordinate system and affine transform.

    Beside ``stack_dimensions``: ``epsg``, the six numbers of the transform ``a`` to ``f``,
    and ``mixed`` if a later tile has another system or transform.
    """
    place = F.struct("epsg", "transform")
    first = tiles.groupBy("seed_id").agg(
        F.min_by(place, "date").alias("p"), (F.count_distinct(F.coalesce("epsg", F.lit(0)), "transform") > 1).alias("mixed")
    )
    numbers = [F.get("p.transform", F.lit(i)).alias(n) for i, n in enumerate("abcdef")]
    return stack_dimensions(tiles).drop("x0", "y0").join(
        first.select("seed_id", "p.epsg", *numbers, "mixed"), "seed_id"
    )
