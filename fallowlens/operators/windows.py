"""Range join of observations with the square windows of seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fallowlens.functions.geo import cell_of
from fallowlens.operators.scenes import in_box


def curve_cell(x: Column, y: Column, cell: float) -> Column:
    """Number of a grid cell along a Z-shaped curve: the bits of its column and row, interleaved.

    Cells that lie near each other have near numbers, so files and ranges sorted by it hold
    compact areas. Valid for 31 bits of either side of the origin.
    """

    def spread(v: Column) -> Column:
        # binary digits read as those of base 4; the argument stands here once, so expressions stay small
        v = (cell_of(v, cell) + F.lit(1 << 30)).bitwiseAND(F.lit((1 << 31) - 1))
        return F.conv(F.bin(v), 4, 10).cast("bigint")

    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def dense_cells(obs: DataFrame, cell: float, most: int, zone: str | None = None) -> DataFrame:
    """(zone,) ``_z, _parts``: cells with more than ``most`` observations, and into how many parts they go.

    Counted with combining on the map side; at most ``rows / most`` cells.
    """
    zones = [] if zone is None else [zone]
    counted = obs.groupBy(*zones, curve_cell(F.col("x"), F.col("y"), cell).alias("_z")).agg(F.count("*").alias("_n"))
    return counted.filter(F.col("_n") > most).select(*zones, "_z", F.ceil(F.col("_n") / most).cast("int").alias("_parts"))


def dealt_window_join(obs: DataFrame, windows: DataFrame, cell: float, most: int, zone: str | None = None) -> DataFrame:
    """``window_join`` whose tasks are even by themselves, without skew handling at run time.

    Both sides meet on the cell's number along the curve. A cell with more than ``most``
    observations is divided into parts of about that many by a hash of the observation,
    also when all of them lie on one spot; the windows that reach into it, a few rows, go to
    all its parts. ``obs`` is read twice, so hand in a stored table.
    """
    zones = [] if zone is None else [zone]
    edges = ["minx", "miny", "maxx", "maxy"]
    kept = [c for c in obs.columns if c != "seed_id"]
    dense = dense_cells(obs, cell, most, zone)
    key = [*zones, "_z"]
    parted = lambda df: df.join(dense, key, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    covered = lambda lo, hi: F.explode(F.sequence(cell_of(F.col(lo), cell), cell_of(F.col(hi), cell)))
    cells = windows.select("seed_id", *edges, *zones, covered("minx", "maxx").alias("_cx")).select(
        "*", covered("miny", "maxy").alias("_cy")
    )
    middle = lambda c: (F.col(c) + 0.5) * cell
    cells = parted(cells.withColumn("_z", curve_cell(middle("_cx"), middle("_cy"), cell)))
    cells = cells.select("seed_id", *edges, *key, F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    # the dense cells are few: their join moves no observation where it is a broadcast
    placed = parted(obs.select(*kept, curve_cell(F.col("x"), F.col("y"), cell).alias("_z")))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in kept]), F.col("_parts")).cast("int")
    placed = placed.withColumn("_part", part).drop("_parts")
    box = in_box(F.col("x"), F.col("y"), *[F.col(e) for e in edges])
    return placed.hint("merge").join(cells, [*key, "_part"]).filter(box).select("seed_id", *kept)


def window_join(
    obs: DataFrame, windows: DataFrame, cell: float, zone: str | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """Observations (``x, y``) inside each window (``minx..maxy``), half-open.

    An equi-join on grid cells replaces the nested-loop join a range condition
    alone would get. With ``cell`` near the window size a window covers at most
    four cells. A cell that draws much of the data is split by Spark's skew-join
    handling, since both sides are shuffled on the cell. ``zone`` names a column of both
    sides, their coordinate system, which then is a part of the cell. ``carried`` names further
    columns of the windows, which come beside each observation.
    """
    zones = [] if zone is None else [zone]
    edges = ["minx", "miny", "maxx", "maxy"]
    kept = [c for c in obs.columns if c != "seed_id"]

    def covered(lo: str, hi: str):
        return F.explode(F.sequence(cell_of(F.col(lo), cell), cell_of(F.col(hi), cell)))

    cells = windows.select("seed_id", *edges, *zones, *carried, covered("minx", "maxx").alias("_cx")).select(
        "*", covered("miny", "maxy").alias("_cy")
    )
    placed = obs.select(
        *kept,
        cell_of(F.col("x"), cell).alias("_cx"),
        cell_of(F.col("y"), cell).alias("_cy"),
    )
    box = in_box(F.col("x"), F.col("y"), *[F.col(e) for e in edges])
    return placed.join(cells, [*zones, "_cx", "_cy"]).filter(box).select("seed_id", *kept, *carried)
