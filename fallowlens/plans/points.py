"""From survey points and scenes to features in one call.

A point's square window is cut from the scenes, its pixels are brought to the window's own
grid, anchored at its upper-left corner, and the seed run follows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.geo import window_around
from fallowlens.functions.indices import add_indices, clean_bands, ndvi
from fallowlens.operators.bare_soil import pixel_statistics
from fallowlens.operators.quality import unique_points
from fallowlens.operators.scenes import last_of_day, select_scenes
from fallowlens.operators.windows import window_join
from fallowlens.plans.batch import SeedRun, consolidate, observed_seeds, seed_features
from fallowlens.schemas import PIXEL_KEYS, Params


EDGES = ("minx", "miny", "maxx", "maxy")
RANGES = ("_r0", "_r1", "_c0", "_c1")
# Parts of the seeds for each shuffle partition, since every pixel is listed as several cells there.
PARTS = 2


def window_ranges(cut: DataFrame, src_res: float | Column, dst_res: float) -> DataFrame:
    """Source pixels (centre ``x, y``) with the cells of their window's grid that they fill.

    ``_window`` holds the edges of the window, so that no pixel is moved to look them up.

    A target pixel takes the source pixel that holds its centre. ``_r0`` to ``_r1`` and ``_c0``
    to ``_c1`` are the rows and columns filled; pixels that fill none are left out.
    """
    minx, miny, maxx, maxy = (F.col(f"_window.{e}") for e in EDGES)

    def targets(offset: Column, extent: Column) -> tuple[Column, Column]:
        near, far = offset - src_res / 2, offset + src_res / 2
        lo = F.greatest(F.ceil(near / dst_res - 0.5), F.lit(0)).cast("int")
        hi = F.least(F.ceil(far / dst_res - 0.5), F.round(extent / dst_res)).cast("int") - 1
        return lo, hi

    rows = targets(maxy - F.col("y"), maxy - miny)
    cols = targets(F.col("x") - minx, maxx - minx)
    kept = [c for c in cut.columns if c not in ("row", "col", "x", "y", "_window")]
    ranges = cut.select(*kept, *[c.alias(k) for k, c in zip(RANGES, (*rows, *cols), strict=True)])
    return ranges.filter((F.col("_r0") <= F.col("_r1")) & (F.col("_c0") <= F.col("_c1")))


def listed_cells(ranges: DataFrame) -> DataFrame:
    """``row, col`` of each cell in the ranges of ``window_ranges``."""
    kept = [c for c in ranges.columns if c not in RANGES]
    rows = ranges.select(*kept, "_c0", "_c1", F.explode(F.sequence("_r0", "_r1")).alias("row"))
    return rows.select(*kept, "row", F.explode(F.sequence("_c0", "_c1")).alias("col"))


def _reaching(
    chosen: DataFrame, edges: DataFrame, window_m: float, src_res: float | Column, coarsest: float, dst_res: float
) -> DataFrame:
    """Pixels of up to ``coarsest`` metres that reach into windows, with the cells they fill."""
    half = coarsest / 2
    # source pixels whose area reaches into the window, also where their centre does not
    wider = edges.filter(F.col("seed_id").isNotNull()).select(
        "seed_id",
        (F.col("minx") - half).alias("minx"),
        (F.col("miny") - half).alias("miny"),
        (F.col("maxx") + half).alias("maxx"),
        (F.col("maxy") + half).alias("maxy"),
        F.struct(*EDGES).alias("_window"),
    )
    cut = window_join(chosen, wider, max(window_m, coarsest), carried=["_window"])
    return window_ranges(cut, src_res, dst_res)


def _cut(chosen: DataFrame, edges: DataFrame, window_m: float, src_res: float, dst_res: float) -> DataFrame:
    """Pixels of one resolution on the grids of the windows they reach into."""
    return listed_cells(_reaching(chosen, edges, window_m, src_res, src_res, dst_res))


def _with_transform(windows: DataFrame, dst_res: float) -> DataFrame:
    transform = F.array(
        F.lit(dst_res), F.lit(0.0), F.col("minx"), F.lit(0.0), F.lit(-dst_res), F.col("maxy")
    )
    return windows.select("seed_id", "lat", "lon", transform.alias("transform"))


def features_from_windows(
    scenes: DataFrame, windows: DataFrame, params: Params, src_res: float = 10.0, dst_res: float = 10.0
) -> SeedRun:
    """``scenes``: pixels of all acquisitions with ``x, y`` and no seed; ``windows``:
    ``seed_id, lat, lon`` and the edges ``minx, miny, maxx, maxy`` in the same system."""
    chosen = select_scenes(scenes, params.start_date, params.end_date, params.max_cloud)
    obs = _cut(chosen, unique_points(windows), params.window_m, src_res, dst_res)
    return seed_features(obs, _with_transform(windows, dst_res), params)


SCENE = ("acq_date", "scene_idx", "cloud_cover")


def as_pieces(sources: Mapping[float, DataFrame], params: Params) -> DataFrame:
    """Pixels of all ``sources`` in one frame, with their resolution in metres as ``res``."""
    named = [b for df in sources.values() for b in params.bands if b in df.columns]
    if sorted(named) != sorted(params.bands):
        raise ValueError(f"each band needs one resolution, given {named}")
    pieces = [
        df.select("x", "y", *SCENE, *[b for b in params.bands if b in df.columns], F.lit(float(res)).alias("res"))
        for res, df in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)


def _chosen_ranges(pieces: DataFrame, coarsest: float, windows: DataFrame, params: Params, dst_res: float) -> DataFrame:
    """Selected pixels of all resolutions with the cells they fill, from one join with the windows."""
    chosen = select_scenes(pieces, params.start_date, params.end_date, params.max_cloud)
    kept = clean_bands(chosen.select("x", "y", *SCENE, "res", *params.bands), params.bands)
    reaching = _reaching(kept, unique_points(windows), params.window_m, F.col("res"), coarsest, dst_res)
    return reaching.drop("res")


def _met(cells: DataFrame, params: Params) -> DataFrame:
    """The pieces of a cell's acquisition as one row."""
    return cells.groupBy("seed_id", "row", "col", *SCENE).agg(*[F.max(b).alias(b) for b in params.bands])


def on_one_grid(
    sources: Mapping[float, DataFrame], windows: DataFrame, params: Params, dst_res: float = 10.0
) -> DataFrame:
    """Bands of several resolutions side by side, one row per target cell and acquisition.

    ``sources`` maps a resolution in metres to pixels with ``x, y``, the scene columns and the
    bands that resolution has; a band has one resolution only. All are cut and brought to the
    windows' grid by one join. The pieces of a cell then meet in one aggregate, combined
    on the map side. A band that a cell's acquisition lacks is missing there.
    """
    pieces = as_pieces(sources, params)
    return _met(listed_cells(_chosen_ranges(pieces, max(sources), windows, params, dst_res)), params)


def features_from_resolutions(
    sources: Mapping[float, DataFrame], windows: DataFrame, params: Params, dst_res: float = 10.0
) -> SeedRun:
    """As ``features_from_windows``, from scenes whose bands come in several resolutions."""
    return features_from_pieces(as_pieces(sources, params), max(sources), windows, params, dst_res)


def features_from_pieces(
    pieces: DataFrame, coarsest: float, windows: DataFrame, params: Params, dst_res: float = 10.0
) -> SeedRun:
    """The same from one frame that holds the pixels of all resolutions, each with its own in ``res``.

    ``coarsest`` is the largest ``res``; bands that a pixel's resolution lacks are missing.

    After the join with the windows pixels move once, to their seed, each with the range of cells
    it fills: there cells are listed, resolutions meet, the last scene of a day is taken, and pixels
    get their statistics. A seed's window is bounded, as are its acquisitions;
    ``params.spread`` deals cells out by pixel instead, where one seed is too large for a task.
    The features tell by themselves which seeds were observed, so the sources are read once for them.
    """
    ranges = _chosen_ranges(pieces, coarsest, windows, params, dst_res)
    # a fixed number: adaptive execution would merge parts by their size before cells are listed
    parts = PARTS * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if params.spread:
        cells = _unplaced(listed_cells(ranges)).repartition(parts, *PIXEL_KEYS)
    else:
        cells = _unplaced(listed_cells(ranges.repartition(parts, "seed_id")))
    daily = last_of_day(_met(cells, params), params.bands)
    is_bare = F.coalesce(ndvi() < params.ndvi_threshold, F.lit(False))
    kept = _bare_or_seen(daily, is_bare, params)
    pixels = pixel_statistics(add_indices(kept), PIXEL_KEYS, params.targets, is_bare)
    observed = observed_seeds(_met(listed_cells(ranges), params), params)
    return consolidate(pixels, windows, observed, params, marked=True, complete=True)


def _unplaced(cells: DataFrame) -> DataFrame:
    """Cells of an acquisition without a scene number lose their place, which fails their seed."""
    known = F.col("scene_idx").isNotNull()
    return cells.withColumns({c: F.when(known, F.col(c)) for c in ("row", "col")})


def _bare_or_seen(daily: DataFrame, is_bare: Column, params: Params) -> DataFrame:
    """Bare rows and those without a place. A seed's other rows become one, without values or a day,
    in the first cell, which lies in any grid: it only tells that the seed was observed."""
    dull = F.col("row").isNotNull() & ~is_bare
    moved = daily.select(
        "seed_id",
        *[F.when(dull, F.lit(0)).otherwise(F.col(c)).alias(c) for c in ("row", "col")],
        *[F.when(~dull, F.col(c)).alias(c) for c in ("acq_date", *params.bands)],
    )
    return moved.groupBy(*PIXEL_KEYS, "acq_date").agg(*[F.max(b).alias(b) for b in params.bands])


def features_from_scenes(
    scenes: DataFrame, points: DataFrame, params: Params, src_res: float = 10.0, dst_res: float = 10.0
) -> SeedRun:
    """The same for points ``seed_id, lat, lon``: a window of ``params.window_m`` around each."""
    windows = window_around(points.select("seed_id", "lat", "lon"), params.window_m, params.dst_epsg)
    return features_from_windows(scenes, windows, params, src_res, dst_res)
