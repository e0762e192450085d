"""Raster tiles: unstacking, exploding, checks and grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.functions.indices import add_indices
from fallowlens.operators import grids, quality
from fallowlens.operators import tiles as t
from fallowlens.operators.bare_soil import flag_bare_soil
from fallowlens.plans import batch, stacks
from fallowlens.plans import tiles as tile_plans
from fallowlens.schemas import BANDS, Params, spatial_names, temporal_names
from fallowlens.session import materialize
from fallowlens.sources import derived

PARAMS = Params(size=(10, 10))

# Every cell of every tile; observed values at tile precision, zero elsewhere.
_CELLS = f"""
tile_days as (select distinct seed_id, acq_date as date from daily),
cells as (
  select d.seed_id, d.date, cast(r as int) as "row", cast(c as int) as col,
    500000 + 1000 * cast(substr(d.seed_id, 6) as bigint) + 10 * (cast(c as int) + 0.5e0) as x,
    4970000 - 10 * (cast(r as int) + 0.5e0) as y,
    {", ".join(f"cast(cast(coalesce({b}, 0) as float) as double) as {b}" for b in BANDS)}
  from tile_days d cross join range(0, 10) a(r) cross join range(0, 10) b(c)
  left join daily o on o.seed_id = d.seed_id and o.acq_date = d.date and o."row" = r and o.col = c)"""
_BANDS = ", ".join(BANDS)


@query(
    "tile_explode",
    q.with_(q.OBS, q.daily(), _CELLS) + f'select seed_id, date, "row", col, x, y, {_BANDS} from cells',
    date="date",
)
def tile_explode(spark: SparkSession, sf: str) -> DataFrame:
    return t.explode_pixels(derived.tiles(spark, sf), BANDS)


@query(
    "strips_to_pixels",
    q.with_(q.OBS, q.daily(), _CELLS) + f'select seed_id, date, "row", col, x, y, {_BANDS} from cells',
    date="date",
)
def strips_to_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Rasters kept as strips of three lines: the same pixels."""
    return t.explode_pixels(t.strips(derived.tiles(spark, sf), 200), BANDS)


@query(
    "tile_explode_by_name",
    q.with_(q.OBS, q.daily(), _CELLS) + 'select seed_id, date, "row", col, x, y, B08, B04 from cells',
    date="date",
)
def tile_explode_by_name(spark: SparkSession, sf: str) -> DataFrame:
    return t.explode_pixels(derived.tiles(spark, sf), ["B08", "B04"], by_name=True)


@query(
    "unstack_dates",
    q.with_(q.OBS, q.daily(), _CELLS) + f'select seed_id, date, "row", col, x, y, {_BANDS} from cells',
    date="date",
)
def unstack_dates(spark: SparkSession, sf: str) -> DataFrame:
    per_date = t.unstack_dates(derived.stacked_tiles(spark, sf), BANDS)
    return t.explode_pixels(per_date, BANDS)


@query(
    "acquisition_dates",
    q.with_(q.OBS)
    + "select seed_id, acq_date as date, row_number() over (partition by seed_id order by acq_date) - 1 "
    "as position from (select distinct seed_id, acq_date from obs)",
    date="date",
)
def acquisition_dates(spark: SparkSession, sf: str) -> DataFrame:
    dated = t.with_dates(derived.stacked_tiles(spark, sf))
    return dated.select("seed_id", F.posexplode("dates").alias("position", "date")).select(
        "seed_id", "date", F.col("position").cast("bigint").alias("position")
    )


@query(
    "stack_to_pixels",
    q.with_(q.OBS, q.daily(), _CELLS, q.indexed("cells"))
    + f"select seed_id, date, \"row\", col, x, y, {sql_rounded('NDVI', 'NDVI')}, "
    "coalesce(NDVI < 0.2, false) as is_baresoil from indexed",
    date="date",
)
def stack_to_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Stacked raster to flagged pixel rows, under the first tile's geometry."""
    # a stack has one transform, which unstacking hands to all its dates
    per_date = t.unstack_dates(derived.stacked_tiles(spark, sf), BANDS)
    df = flag_bare_soil(add_indices(t.explode_pixels(per_date, BANDS)), 0.2)
    return round_columns(
        df.select("seed_id", "date", "row", "col", "x", "y", "NDVI", "is_baresoil"), ["NDVI"]
    )


@query(
    "centre_pixel",
    q.with_(q.OBS, q.daily(), _CELLS)
    + f'select seed_id, date, "row", col, x, y, {_BANDS} from cells where "row" = 5 and col = 5',
    date="date",
)
def centre_pixel(spark: SparkSession, sf: str) -> DataFrame:
    return t.centre_pixel(derived.tiles(spark, sf), BANDS)


@query(
    "raster_min_max",
    q.with_(q.OBS, q.daily(), _CELLS)
    + f"select min(least({_BANDS})) as min_value, max(greatest({_BANDS})) as max_value from cells",
)
def raster_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return t.raster_min_max(derived.tiles(spark, sf))


@query(
    "stack_dimensions",
    q.with_(q.OBS)
    + "select seed_id, count(distinct acq_date) as n_dates, 6 as n_bands, 10 as height, 10 as width, "
    "500000e0 + 1000 * cast(substr(seed_id, 6) as bigint) as x0, 4970000e0 as y0 "
    "from obs group by seed_id",
)
def stack_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    return t.stack_dimensions(derived.tiles(spark, sf))


@query(
    "band_order",
    "select p_partkey, p_size % 6 + 1 as n_bands, "
    "list_extract(['B02', 'B03', 'B04', 'B08', 'B11', 'B12'], cast(p_size % 6 + 1 as int)) as last_band "
    "from part",
)
def band_order(spark: SparkSession, sf: str) -> DataFrame:
    """Band lists read back from their metadata documents."""
    part = derived.table(spark, sf, "part")
    n = (F.col("p_size") % 6 + 1).cast("int")
    names = F.slice(F.array(*[F.lit(b) for b in BANDS]), 1, n)
    documents = part.select("p_partkey", F.to_json(F.struct(names.alias("bands"))).alias("j"))
    read = documents.select("p_partkey", t.band_order(F.col("j")).alias("b"))
    return read.select(
        "p_partkey", F.size("b").alias("n_bands"), F.element_at("b", -1).alias("last_band")
    )


# Faults are placed by account balance of the seed's supplier.
NO_PLACE = (-10000.0, 600.0)
NO_DATES = (1500.0, 2000.0)
CUT_DATA = (1900.0, 3100.0)
UNEVEN = (4000.0, 5000.0)
TWICE = (6000.0, 7000.0)


def _within(band: tuple[float, float]) -> Column:
    return (F.col("balance") >= band[0]) & (F.col("balance") < band[1])


def _sql_within(band: tuple[float, float]) -> str:
    return f"(balance >= {band[0]} and balance < {band[1]})"


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    return derived.table(spark, sf, "supplier").select(
        derived.seed_name(F.col("s_suppkey")).alias("seed_id"), F.col("s_acctbal").alias("balance")
    )


def _broken_stacks(spark: SparkSession, sf: str) -> DataFrame:
    """Stacks of which some lost their dates and some a part of their rasters."""
    stacks = derived.stacked_tiles(spark, sf).join(_balances(spark, sf), "seed_id")
    return stacks.withColumns(
        {
            "userdata": F.when(_within(NO_DATES), F.lit("{}")).otherwise(F.col("userdata")),
            "data": F.when(_within(CUT_DATA), F.slice("data", 1, 100)).otherwise(F.col("data")),
        }
    ).drop("balance")


@query(
    "stack_validation",
    q.with_(q.OBS, q.SEEDS)
    + f"select seed_id, lat, lon, case when {_sql_within(NO_DATES)} then 'acquisition dates missing' "
    "else 'band count mismatch' end as error from seeds "
    f"where seed_id in (select seed_id from obs) and ({_sql_within(NO_DATES)} or {_sql_within(CUT_DATA)})",
)
def stack_validation(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.stack_errors(_broken_stacks(spark, sf), len(BANDS))
    return quality.error_table(derived.seeds(spark, sf), [found])


@query(
    "error_quarantine",
    q.with_(q.OBS, q.SEEDS)
    + f""", listed as (
  select seed_id, case when {_sql_within(NO_PLACE)} then null else lat end as lat, lon, balance from seeds
  union all select concat('seed_n', cast(n_nationkey as varchar)), 40 + n_nationkey / 1e1, 9e0, null from nation
  union all select seed_id, lat, lon, balance from seeds where {_sql_within(TWICE)}),
ids as (select seed_id, count(*) as n, count(*) filter (lat is null) as n_null from listed group by seed_id),
reasons as (
  select l.seed_id, l.lat, l.lon, case
    when n_null > 0 then 'missing coordinates'
    when n > 1 then 'duplicate seed_id'
    when l.seed_id not in (select seed_id from obs) then 'no tiles'
    when {_sql_within(NO_DATES)} then 'acquisition dates missing'
    when {_sql_within(CUT_DATA)} then 'band count mismatch'
    when {_sql_within(UNEVEN)} then 'shape mismatch' end as error
  from listed l join ids i on l.seed_id = i.seed_id)
select seed_id, lat, lon, error from reasons where error is not null""",
)
def error_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """All reasons together; each failing seed row carries its first one."""
    base = derived.seeds(spark, sf).join(_balances(spark, sf), "seed_id").drop("transform")
    extra = derived.table(spark, sf, "nation").select(
        F.concat(F.lit("seed_n"), F.col("n_nationkey").cast("string")).alias("seed_id"),
        (40 + F.col("n_nationkey") / F.lit(10.0)).alias("lat"),
        F.lit(9.0).alias("lon"),
        F.lit(None).cast("double").alias("balance"),
    )
    seeds = (
        base.withColumn("lat", F.when(~_within(NO_PLACE), F.col("lat")))
        .unionByName(extra)
        .unionByName(base.filter(_within(TWICE)))
    )
    tiles = derived.tiles(spark, sf).join(_balances(spark, sf), "seed_id")
    late = _within(UNEVEN) & (F.dayofmonth("date") > 15)
    uneven = tiles.withColumn("height", F.when(late, 9).otherwise(F.col("height")))
    found = [
        quality.coordinate_errors(seeds),
        quality.duplicate_errors(seeds),
        quality.stack_errors(_broken_stacks(spark, sf), len(BANDS)),
        quality.missing_errors(seeds, tiles),
        quality.shape_errors(uneven),
    ]
    return quality.error_table(seeds, found)


@query(
    "truncated_tiles",
    q.with_(q.OBS, q.SEEDS, q.daily(), _CELLS, q.indexed("cells"), q.pixels(0.2), q.seed_stats(2))
    + f"""select s.seed_id, case when {_sql_within(CUT_DATA)} then 'shape mismatch' end as error,
  case when not {_sql_within(CUT_DATA)} then coalesce(n_pixels, 0) end as n_pixels,
  {sql_rounded(f'case when not {_sql_within(CUT_DATA)} then B08_median_bs_space_mean end', 'B08_median_bs_space_mean')}
from seeds s left join stats t on s.seed_id = t.seed_id where s.seed_id in (select seed_id from cells)""",
)
def truncated_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds with a raster cut short end as errors, the others finish."""
    tiles = derived.tiles(spark, sf).join(_balances(spark, sf), "seed_id")
    short = F.slice("data", 1, 598 + F.dayofmonth("date") % 2)
    broken = tiles.withColumn("data", F.when(_within(CUT_DATA), short).otherwise(F.col("data"))).drop("balance")
    run = tile_plans.seed_features(broken, derived.seeds(spark, sf), PARAMS)
    done = run.features.select("seed_id", F.lit(None).cast("string").alias("error"), "n_pixels", "B08_median_bs_space_mean")
    failed = run.errors.select("seed_id", "error")
    return round_columns(done.unionByName(failed, allowMissingColumns=True), ["B08_median_bs_space_mean"])


@query(
    "stray_pixels",
    q.with_(q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2))
    + f"""select s.seed_id, case when {_sql_within(UNEVEN)} then 'shape mismatch' end as error,
  case when not {_sql_within(UNEVEN)} then sum(n_obs_baresoil)::bigint end as n_obs,
  case when not {_sql_within(UNEVEN)} then 100 end as n_cells
from seeds s join pixels p on s.seed_id = p.seed_id group by s.seed_id, balance""",
)
def stray_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Grids in blocks of four cells; a seed with a pixel outside its grid has an error in their place."""
    pixels = materialize(_pixel_features(spark, sf)).join(_balances(spark, sf), "seed_id")
    moved = pixels.withColumn("row", F.when(_within(UNEVEN), F.col("row") + 10).otherwise(F.col("row"))).drop("balance")
    cells = grids.grid_cells(grids.qa_grids(moved, PARAMS.size, block=4), ["n_obs"])
    drawn = cells.groupBy("seed_id").agg(F.sum("n_obs").alias("n_obs"), F.count("*").cast("int").alias("n_cells"))
    faults = quality.error_table(derived.seeds(spark, sf), [grids.grid_faults(moved, PARAMS.size)]).select("seed_id", "error")
    return drawn.select("seed_id", F.lit(None).cast("string").alias("error"), "n_obs", "n_cells").unionByName(
        faults, allowMissingColumns=True
    )


@query(
    "stack_geometry",
    q.with_(q.OBS)
    + "select seed_id, count(distinct acq_date) as n_dates, 6 as n_bands, 10 as height, 10 as width, "
    "cast(32632 + cast(substr(seed_id, 6) as bigint) % 2 as int) as epsg, 10e0 as a, 0e0 as b, "
    "500000e0 + 1000 * cast(substr(seed_id, 6) as bigint) as c, 0e0 as d, -10e0 as e, 4970000e0 as f, "
    "count(distinct acq_date) > 1 and cast(substr(seed_id, 6) as bigint) % 3 = 0 as mixed "
    "from obs group by seed_id",
)
def stack_geometry(spark: SparkSession, sf: str) -> DataFrame:
    """Coordinate system and transform of each stack; every third seed's later tiles lie elsewhere."""
    number = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint")
    tiles = derived.tiles(spark, sf).withColumn("epsg", (32632 + number % 2).cast("int"))
    first = tiles.groupBy("seed_id").agg(F.min("date").alias("first"))
    later = (F.col("date") > F.col("first")) & (number % 3 == 0)
    moved = F.transform("transform", lambda v: F.when(later, v + 30.0).otherwise(v))
    return t.stack_geometry(tiles.join(first, "seed_id").withColumn("transform", moved).drop("first"))


def _pixel_features(spark: SparkSession, sf: str) -> DataFrame:
    daily = batch.daily_pixels(derived.scene_obs(spark, sf), PARAMS)
    return batch.pixel_features(daily, derived.seeds(spark, sf), PARAMS)


_FULL_GRID = """
grid as (
  select seed_id, cast(r as int) as "row", cast(c as int) as col
  from seeds cross join range(0, 10) a(r) cross join range(0, 10) b(c)
  where seed_id in (select seed_id from pixels))"""
_GRID_CTES = (
    q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2), _FULL_GRID,
)


@query(
    "composite_grid",
    q.with_(*_GRID_CTES)
    + " union all ".join(
        f"select g.seed_id, '{b}' as band, g.\"row\", g.col, "
        f"round(cast(cast(coalesce(case when n_obs_baresoil >= 2 then \"{b}_median_bs\" end, 0) as float) as double), 5) "
        "+ 0e0 as value "
        'from grid g left join pixels p on g.seed_id = p.seed_id and g."row" = p."row" and g.col = p.col'
        for b in BANDS
    ),
)
def composite_grid(spark: SparkSession, sf: str) -> DataFrame:
    composite = grids.composite_grids(_pixel_features(spark, sf), PARAMS.size)
    cells = grids.grid_cells(composite.withColumnRenamed("grid", "value"), ["value"])
    return round_columns(cells.withColumn("value", F.col("value").cast("double")), ["value"], 5)


_OWN_GRID = _FULL_GRID.replace("range(0, 10) a(r) cross join range(0, 10) b(c)", "range(0, 13) a(r) cross join range(0, 12) b(c)").replace(
    "where", "where r < 10 + cast(substr(seed_id, 6) as bigint) % 4 and c < 10 + cast(substr(seed_id, 6) as bigint) % 3 and"
)


@query(
    "qa_grids_any_size",
    q.with_(*_GRID_CTES[:-1], _OWN_GRID)
    + "select g.seed_id, g.\"row\", g.col, cast(coalesce(n_obs_baresoil, 0) as int) as n_obs "
    'from grid g left join pixels p on g.seed_id = p.seed_id and g."row" = p."row" and g.col = p.col',
)
def qa_grids_any_size(spark: SparkSession, sf: str) -> DataFrame:
    """Grids as large as each seed's own raster."""
    pixels = _pixel_features(spark, sf)
    number = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint")
    shapes = pixels.select("seed_id").distinct().select(
        "seed_id", (10 + number % 3).cast("int").alias("width"), (10 + number % 4).cast("int").alias("height")
    )
    return grids.grid_cells(grids.qa_grids(pixels, seeds=shapes), ["n_obs"]).select("seed_id", "row", "col", "n_obs")


@query(
    "tile_explode_first_transform",
    q.with_(q.OBS, q.daily(), _CELLS) + f'select seed_id, date, "row", col, x, y, {_BANDS} from cells',
    date="date",
)
def tile_explode_first_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Later tiles with another corner take that of their seed's first tile."""
    tiles = derived.tiles(spark, sf)
    first = tiles.groupBy("seed_id").agg(F.min("date").alias("first"))
    moved = F.transform("transform", lambda v: F.when(F.col("date") > F.col("first"), v + 500.0).otherwise(v))
    shifted = tiles.join(first, "seed_id").withColumn("transform", moved).drop("first")
    return t.explode_pixels(t.with_first_transform(shifted), BANDS)


@query(
    "qa_grids",
    q.with_(*_GRID_CTES)
    + "select g.seed_id, g.\"row\", g.col, "
    "round(cast(cast(case when n_obs_baresoil >= 2 then NDVI_median_bs end as float) as double), 5) + 0e0 as ndvi, "
    "round(cast(cast(case when n_obs_baresoil >= 2 then NDMI_median_bs end as float) as double), 5) + 0e0 as ndmi, "
    "cast(coalesce(n_obs_baresoil, 0) as int) as n_obs "
    'from grid g left join pixels p on g.seed_id = p.seed_id and g."row" = p."row" and g.col = p.col',
)
def qa_grids(spark: SparkSession, sf: str) -> DataFrame:
    maps = grids.qa_grids(_pixel_features(spark, sf), PARAMS.size)
    cells = grids.grid_cells(maps, ["ndvi", "ndmi", "n_obs"])
    wide = cells.withColumns({c: F.col(c).cast("double") for c in ("ndvi", "ndmi")})
    return round_columns(wide, ["ndvi", "ndmi"], 5)


_SHOWN = spatial_names(temporal_names())


def _from_cells_sql(threshold: float) -> str:
    return (
        q.with_(
            q.OBS, q.SEEDS, q.daily(), _CELLS, q.indexed("cells"), q.pixels(threshold), q.seed_stats(2)
        )
        + "select s.seed_id, lat, lon, coalesce(n_pixels, 0) as n_pixels, "
        "coalesce(n_pixels_with_min_obs, 0) as n_pixels_with_min_obs, "
        "mean_n_obs_baresoil, median_n_obs_baresoil, "
        + ", ".join(sql_rounded(f'"{c}"', c) for c in _SHOWN)
        + " from seeds s left join stats t on s.seed_id = t.seed_id "
        "where s.seed_id in (select seed_id from cells)"
    )


def _shown(features: DataFrame) -> DataFrame:
    counts = ["n_pixels", "n_pixels_with_min_obs", "mean_n_obs_baresoil", "median_n_obs_baresoil"]
    return round_columns(features.select("seed_id", "lat", "lon", *counts, *_SHOWN), _SHOWN)


@query("seed_features_from_stacks", _from_cells_sql(-0.45))
def seed_features_from_stacks(spark: SparkSession, sf: str) -> DataFrame:
    """From stacked rasters; the low threshold leaves seeds without a bare pixel."""
    stacked = derived.stacked_tiles(spark, sf)
    params = Params(ndvi_threshold=-0.45)
    return _shown(stacks.seed_features(stacked, derived.seeds(spark, sf), params).features)


@query("seed_features_from_tiles", _from_cells_sql(0.2))
def seed_features_from_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """From per-date rasters."""
    tiles = derived.tiles(spark, sf)
    return _shown(tile_plans.seed_features(tiles, derived.seeds(spark, sf), PARAMS).features)


@query("seed_features_any_size", _from_cells_sql(0.2))
def seed_features_any_size(spark: SparkSession, sf: str) -> DataFrame:
    """Rasters of two sizes. The larger ones' further pixels hold no data."""
    odd = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint") % 2 == 1
    tiles = derived.tiles(spark, sf).filter(odd).unionByName(derived.tiles(spark, sf, (13, 11)).filter(~odd))
    return _shown(tile_plans.seed_features(tiles, derived.seeds(spark, sf), Params()).features)
