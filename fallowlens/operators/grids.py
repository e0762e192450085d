"""Per-seed maps as two-dimensional arrays, whole or in blocks.

Only observed pixels are shuffled, once. Cells are sorted by place and the gaps between
neighbours are filled, so that building takes time in proportion to the cells of the map.
A grid is as large as the seed's raster: ``width, height`` of the seed table, else a declared
size, else the pixels' extent. A seed with a pixel outside its grid has no grid;
``grid_faults`` lists it, and the others are not held up.

``block`` divides maps into squares of that many cells, each a row of its own that may be
built in a task of its own: ``block_row, block_col`` and the upper-left cell ``row0, col0``.
Give it a stored pixel table, since the seeds' extents are then read first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fallowlens.operators.quality import fault_rows
from fallowlens.schemas import BANDS

BLOCK_KEYS = ["block_row", "block_col", "row0", "col0"]


def _filled(items: Column, kind: T.StructType, first: Column, n: Column, filler: Column) -> Column:
    """``n`` values from place ``first`` on: those of ``items`` (at, v), sorted by place, and fillers between them.

    Each item is paired with the one before it, so none is looked up. ``kind`` is the items' type.
    """
    none = F.array().cast(T.ArrayType(kind["v"].dataType))
    items = F.coalesce(items, F.array().cast(T.ArrayType(kind)))
    edge = lambda at: F.array(F.struct(at.cast("int").alias("at"), F.lit(None).cast(kind["v"].dataType).alias("v")))

    def part(x: Column, before: Column) -> Column:
        value = F.when(x["at"] < first + n, F.array(x["v"])).otherwise(none)
        gap = F.array_repeat(filler, x["at"] - before["at"] - 1)
        return F.when(x["at"] == before["at"], none).otherwise(F.concat(gap, value))

    return F.flatten(F.zip_with(F.concat(items, edge(first + n)), F.concat(edge(first - 1), items), part))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row, however often they are used."""
    made = F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))
    return df.select(*[c for c in df.columns if c not in columns], made)


def _shapes(
    pixels: DataFrame, size: tuple[int, int] | None, seeds: DataFrame | None
) -> DataFrame:
    """``seed_id, width, height, outside`` of every seed with a pixel, and of every listed one."""
    extent = pixels.groupBy("seed_id").agg(
        F.least(F.min("row"), F.min("col")).alias("_least"),
        (F.max("row") + 1).alias("_rows"),
        (F.max("col") + 1).alias("_cols"),
        F.bool_or(F.col("row").isNull() | F.col("col").isNull()).alias("_lost"),
    )
    return _shaped(extent, size, seeds)


def _shaped(extent: DataFrame, size: tuple[int, int] | None, seeds: DataFrame | None) -> DataFrame:
    own = seeds is not None and {"width", "height"} <= set(seeds.columns)
    if seeds is not None:
        listed = seeds.select("seed_id", *(["width", "height"] if own else [])).distinct()
        extent = listed.join(extent, "seed_id", "left")
    if not own:
        width, height = (F.lit(size[0]), F.lit(size[1])) if size else (F.col("_cols"), F.col("_rows"))
        extent = extent.withColumns({"width": F.coalesce(width, F.lit(0)), "height": F.coalesce(height, F.lit(0))})
    outside = (F.col("_least") < 0) | (F.col("_rows") > F.col("height")) | (F.col("_cols") > F.col("width"))
    return extent.withColumn("outside", F.coalesce(F.col("_lost"), F.lit(False)) | F.coalesce(outside, F.lit(False)))


def grid_faults(
    pixels: DataFrame, size: tuple[int, int] | None = None, seeds: DataFrame | None = None
) -> DataFrame:
    """Seeds with a pixel outside their grid, as findings for ``quality.error_table``."""
    return fault_rows(_shapes(pixels, size, seeds).filter("outside"), "shape mismatch")


def grids(
    pixels: DataFrame,
    values: Mapping[str, tuple[Column, Column]],
    size: tuple[int, int] | None = None,
    seeds: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """One row per seed, or per block, with a height x width array per entry of ``values``.

    ``values`` maps an output to its value and its filler for absent pixels. With
    ``seeds`` every listed seed gets grids, also one without any pixel. Of pixels that
    share a place the smallest values count.
    """
    names = list(values)
    own = F.struct(*[F.coalesce(v, filler).alias(k) for k, (v, filler) in values.items()]).alias("v")
    of = (lambda c: F.lit(0)) if block is None else (lambda c: F.floor(F.col(c) / block).cast("int"))
    keys = ["seed_id", "block_row", "block_col"]
    cells = pixels.select(
        "seed_id", of("row").alias("block_row"), of("col").alias("block_col"), "row", "col", own
    ).repartition(*(keys if block else ["seed_id"]))
    lines = cells.groupBy(*keys, "row").agg(
        F.sort_array(F.collect_list(F.struct(F.col("col").alias("at"), "v"))).alias("line"),
    )
    sheets = lines.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("row").alias("at"), F.col("line").alias("v"))),
                     lambda a, b: a["at"] - b["at"]).alias("_lines"),
        F.least(F.min("row"), F.min(F.get("line", F.lit(0))["at"])).alias("_least"),
        (F.max("row") + 1).alias("_rows"),
        (F.max(F.get("line", F.size("line") - 1)["at"]) + 1).alias("_cols"),
        F.bool_or(F.col("row").isNull() | F.exists("line", lambda x: x["at"].isNull())).alias("_lost"),
    )
    if block is None:
        placed = _shaped(sheets, size, seeds).filter(~F.col("outside"))
        placed = placed.withColumns({"row0": F.lit(0), "col0": F.lit(0)})
        kept = ["seed_id"]
    else:
        places = lambda n: F.explode(F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1))
        shapes = _shapes(pixels, size, seeds).filter(~F.col("outside") & (F.col("width") > 0) & (F.col("height") > 0))
        blocks = shapes.select("seed_id", "width", "height", places(F.col("height")).alias("block_row")).select(
            "*", places(F.col("width")).alias("block_col")
        )
        # a merge, so that the cells stay where they were dealt
        placed = blocks.join(sheets.select(*keys, "_lines").hint("merge"), keys, "left").withColumns({
            "row0": F.col("block_row") * block, "col0": F.col("block_col") * block,
        })
        placed = placed.withColumns({
            "height": F.least(F.lit(block), F.col("height") - F.col("row0")),
            "width": F.least(F.lit(block), F.col("width") - F.col("col0")),
        })
        kept = ["seed_id", *BLOCK_KEYS]
    filler = F.struct(*[f.alias(k) for k, (_, f) in values.items()])
    kind = sheets.schema["_lines"].dataType.elementType
    line = kind["v"].dataType.elementType
    drawn = F.transform(
        "_lines",
        lambda s: F.struct(s["at"].alias("at"), _filled(s["v"], line, F.col("col0"), F.col("width"), filler).alias("v")),
    )
    filled = _once(placed, _lines=drawn, _gap=F.array_repeat(filler, F.col("width")))
    kind = filled.schema["_lines"].dataType.elementType
    whole = _once(filled, _g=_filled(F.col("_lines"), kind, F.col("row0"), F.col("height"), F.col("_gap"))).select(*kept, "_g")

    def sheet(k: str) -> Column:
        return F.transform("_g", lambda line: line[k]).alias(k)

    return whole.select(*kept, *map(sheet, names))


def composite_grids(
    pixels: DataFrame,
    size: tuple[int, int] | None = None,
    bands: Sequence[str] = BANDS,
    seeds: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """Median bare-soil composite, one row per seed (and block) and band; gaps are 0."""
    zero = F.lit(0.0).cast("float")
    values = {b: (F.col(f"{b}_median_bs").cast("float"), zero) for b in bands}
    wide = grids(pixels, values, size, seeds, block)
    kept = [c for c in wide.columns if c not in bands]
    stacked = F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("grid")) for b in bands])
    return wide.select(*kept, F.inline(stacked))


def qa_grids(
    pixels: DataFrame,
    size: tuple[int, int] | None = None,
    seeds: DataFrame | None = None,
    block: int | None = None,
) -> DataFrame:
    """NDVI and NDMI medians (gaps stay missing) and observation counts (gaps are 0)."""
    missing = F.lit(None).cast("float")
    zero = F.lit(0).cast("int")
    values = {
        "ndvi": (F.col("NDVI_median_bs").cast("float"), missing),
        "ndmi": (F.col("NDMI_median_bs").cast("float"), missing),
        "n_obs": (F.col("n_obs_baresoil").cast("int"), zero),
    }
    return grids(pixels, values, size, seeds, block)


def grid_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Grid arrays back as one row per cell; blocks at their place in the whole grid."""
    blocked = set(BLOCK_KEYS) <= set(df.columns)
    kept = [c for c in df.columns if c not in (*columns, *(BLOCK_KEYS if blocked else []))]
    corner = BLOCK_KEYS[2:] if blocked else []
    rows = df.select(*kept, *corner, F.posexplode(F.arrays_zip(*columns)).alias("row", "_r"))
    zipped = F.arrays_zip(*[F.col("_r")[c].alias(c) for c in columns])
    cells = rows.select(*kept, *corner, "row", F.posexplode(zipped).alias("col", "_c"))
    if blocked:
        cells = cells.withColumns({"row": F.col("row") + F.col("row0"), "col": F.col("col") + F.col("col0")})
    return cells.select(*kept, "row", "col", *[F.col("_c")[c].alias(c) for c in columns])
