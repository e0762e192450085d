"""Indices, bare-soil filter, pixel and seed features."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.functions.indices import add_indices
from fallowlens.operators.bare_soil import bare_soil_only, flag_bare_soil
from fallowlens.operators.quality import error_table, missing_errors
from fallowlens.operators.scenes import last_of_day
from fallowlens.operators.spatial import pixel_coverage, seed_statistics
from fallowlens.plans import batch, points, single_point
from fallowlens.schemas import (
    BANDS,
    INDICES,
    PIXEL_KEYS,
    Params,
    pixel_columns,
    seed_columns,
    spatial_names,
    temporal_names,
)
from fallowlens.sources import derived
from fallowlens.streaming import runs
from fallowlens.streaming.incremental import merge_runs

PARAMS = Params(size=(10, 10))
SPARSE = Params(ndvi_threshold=-0.5)

_TEMPORAL = temporal_names()
_SPATIAL = spatial_names(_TEMPORAL)
_COUNT_STATS = ["mean_n_obs_baresoil", "median_n_obs_baresoil"]


def _seed_run(spark: SparkSession, sf: str, params: Params) -> batch.SeedRun:
    return batch.seed_features(derived.scene_obs(spark, sf), derived.seeds(spark, sf), params)


def _pixels(spark: SparkSession, sf: str, mask_n_obs: bool) -> DataFrame:
    daily = batch.daily_pixels(derived.scene_obs(spark, sf), PARAMS)
    df = batch.pixel_features(daily, derived.seeds(spark, sf), PARAMS, mask_n_obs)
    return round_columns(df, _TEMPORAL)


_INDEX_COLS = ", ".join(sql_rounded(c, c) for c in INDICES)
_DAILY = q.with_(q.OBS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed())


@query(
    "spectral_indices",
    q.with_(q.OBS, q.indexed("obs"))
    + f'select seed_id, "row", col, scene_idx, {_INDEX_COLS} from indexed',
)
def spectral_indices(spark: SparkSession, sf: str) -> DataFrame:
    df = derived.scene_obs(spark, sf).transform(add_indices)
    return round_columns(df.select("seed_id", "row", "col", "scene_idx", *INDICES), INDICES)


@query(
    "bare_soil_flag",
    q.with_(q.OBS, q.indexed("obs"))
    + 'select seed_id, "row", col, scene_idx, coalesce(NDVI < 0.2, false) as is_baresoil from indexed',
)
def bare_soil_flag(spark: SparkSession, sf: str) -> DataFrame:
    df = flag_bare_soil(add_indices(derived.scene_obs(spark, sf)), 0.2)
    return df.select("seed_id", "row", "col", "scene_idx", "is_baresoil")


@query(
    "bare_soil_filter",
    q.with_(q.OBS, q.indexed("obs"))
    + f'select seed_id, "row", col, scene_idx, {", ".join(BANDS)}, {sql_rounded("NDVI", "NDVI")} '
    "from indexed where NDVI < 0.2",
)
def bare_soil_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = bare_soil_only(flag_bare_soil(add_indices(derived.scene_obs(spark, sf)), 0.2))
    return round_columns(df.select("seed_id", "row", "col", "scene_idx", *BANDS, "NDVI"), ["NDVI"])


@query(
    "pixel_timeseries",
    q.with_(q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed())
    + 'select i.seed_id, lat as seed_lat, lon as seed_lon, acq_date as date, "row", col, x, y, '
    + f'{", ".join(BANDS)}, {_INDEX_COLS}, coalesce(NDVI < 0.2, false) as is_baresoil '
    + "from indexed i join seeds s on i.seed_id = s.seed_id",
    date="date",
)
def pixel_timeseries(spark: SparkSession, sf: str) -> DataFrame:
    daily = batch.daily_pixels(derived.scene_obs(spark, sf), PARAMS)
    return round_columns(batch.pixel_timeseries(daily, derived.seeds(spark, sf), PARAMS), INDICES)


def _pixel_sql(mask_n_obs: bool) -> str:
    masked = {"n_obs_baresoil"} if mask_n_obs else set()
    cols = []
    for c in pixel_columns():
        if c in masked:
            cols.append(f"cast(case when {c} >= {PARAMS.min_obs} then {c} end as double) as {c}")
        elif c in _TEMPORAL:
            cols.append(sql_rounded(f'case when n_obs_baresoil >= {PARAMS.min_obs} then "{c}" end', c))
        else:
            cols.append(f'"{c}"')
    return (
        q.with_(
            q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2)
        )
        + f"select p.seed_id, lat as seed_lat, lon as seed_lon, {', '.join(cols)} "
        + "from pixels p join seeds s on p.seed_id = s.seed_id"
    )


@query("pixel_features", _pixel_sql(False))
def pixel_features(spark: SparkSession, sf: str) -> DataFrame:
    return _pixels(spark, sf, False)


@query("pixel_features_masked_n", _pixel_sql(True))
def pixel_features_masked_n(spark: SparkSession, sf: str) -> DataFrame:
    df = _pixels(spark, sf, True)
    return df.withColumn("n_obs_baresoil", F.col("n_obs_baresoil").cast("double"))


def _seed_sql(params: Params) -> str:
    constants = {
        "window_m": f"cast({params.window_m} as double)",
        "start_date": f"'{params.start_date}'",
        "end_date": f"'{params.end_date}'",
        "ndvi_threshold": f"cast({params.ndvi_threshold} as double)",
        "max_cloud_coverage": f"cast({params.max_cloud} as int)",
    }
    cols = []
    for c in seed_columns():
        if c in constants:
            cols.append(f"{constants[c]} as {c}")
        elif c in _SPATIAL or c in _COUNT_STATS:
            cols.append(sql_rounded(f'"{c}"', c))
        elif c.startswith("n_pixels"):
            cols.append(f"coalesce({c}, 0) as {c}")
        else:
            cols.append(f"s.{c}")
    return (
        q.with_(
            q.OBS,
            q.SEEDS,
            q.selected(params.max_cloud, params.start_date, params.end_date),
            q.daily("chosen"),
            q.indexed(),
            q.pixels(params.ndvi_threshold),
            q.seed_stats(params.min_obs),
        )
        + f"select {', '.join(cols)} from seeds s left join stats t on s.seed_id = t.seed_id "
        + "where s.seed_id in (select seed_id from chosen)"
    )


@query("seed_features", _seed_sql(PARAMS))
def seed_features(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(_seed_run(spark, sf, PARAMS).features, _SPATIAL + _COUNT_STATS)


@query("seed_features_empty_seed", _seed_sql(SPARSE))
def seed_features_empty_seed(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(_seed_run(spark, sf, SPARSE).features, _SPATIAL + _COUNT_STATS)


@query(
    "pixel_coverage",
    q.with_(
        q.OBS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2),
        q.seed_stats(2),
    )
    + "select seed_id, n_pixels_with_min_obs, "
    + sql_rounded("n_pixels_with_min_obs / 100e0", "pixel_coverage")
    + " from stats",
)
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    daily = batch.daily_pixels(derived.scene_obs(spark, sf), PARAMS)
    stats = seed_statistics(batch.pixel_stats(daily, PARAMS), PARAMS.min_obs, PARAMS.size)
    df = pixel_coverage(stats, PARAMS.size)
    return round_columns(
        df.select("seed_id", "n_pixels_with_min_obs", "pixel_coverage"), ["pixel_coverage"]
    )


JUNE = (Params(end_date="2024-06-15"), Params(start_date="2024-06-16", ndvi_threshold=0.1))


# Means of a few decimals often end in a 5 where they are rounded; a small shift decides them.
_SHIFT = "1.3e-7"
_SHIFTED = ", ".join(f'round("{c}" + {_SHIFT}, 6) as "{c}"' for c in _SPATIAL + _COUNT_STATS)


@query(
    "merged_runs",
    f"select * replace ({_SHIFTED}) from ("
    + " union all ".join(f"select * from ({_seed_sql(p)})" for p in JUNE)
    + ")",
)
def merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Features of two runs over the halves of a month."""
    merged = merge_runs(*[_seed_run(spark, sf, p).features for p in JUNE])
    shifted = {*_SPATIAL, *_COUNT_STATS}
    return merged.selectExpr(
        *[f"round(`{c}` + {_SHIFT}D, 6) as `{c}`" if c in shifted else f"`{c}`" for c in merged.columns]
    )


_POINT_CTES = (
    q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2), q.seed_stats(2),
)


def _point_run(spark: SparkSession, sf: str) -> single_point.PointRun:
    """The single-point form of every point."""
    daily = batch.daily_pixels(derived.scene_obs(spark, sf), PARAMS)
    return single_point.aggregate_point(daily, derived.seeds(spark, sf), PARAMS)


@query(
    "single_point_series",
    q.with_(*_POINT_CTES)
    + f'select acq_date as date, "row", col, x, y, {", ".join(BANDS)}, {_INDEX_COLS} '
    + "from indexed where seed_id in (select seed_id from seeds)",
    date="date",
)
def single_point_series(spark: SparkSession, sf: str) -> DataFrame:
    """The 17-column series of each point."""
    return round_columns(_point_run(spark, sf).series, INDICES)


@query(
    "single_point_pixels",
    _pixel_sql(True).replace("select p.seed_id, lat as seed_lat, lon as seed_lon, ", "select "),
)
def single_point_pixels(spark: SparkSession, sf: str) -> DataFrame:
    """Pixel features of each point; under-observed pixels lose their count too."""
    df = round_columns(_point_run(spark, sf).pixels, _TEMPORAL)
    return df.withColumn("n_obs_baresoil", F.col("n_obs_baresoil").cast("double"))


@query(
    "single_point_row",
    q.with_(*_POINT_CTES)
    + "select lat, lon, cast(100 as double) as window_m, '2024-06-01' as start_date, '2024-06-30' as end_date, "
    "2 as min_obs_baresoil, coalesce(n_pixels, 0) as n_pixels, "
    "coalesce(n_pixels_with_min_obs, 0) as n_pixels_with_min_obs, "
    + ", ".join(sql_rounded(f'"{c}"', c) for c in _COUNT_STATS + _SPATIAL)
    + " from seeds s left join stats t on s.seed_id = t.seed_id where s.seed_id in (select seed_id from chosen)",
)
def single_point_row(spark: SparkSession, sf: str) -> DataFrame:
    """The 118-column row of each point."""
    run = _seed_run(spark, sf, PARAMS)
    return round_columns(single_point.point_row(run.features, PARAMS), _COUNT_STATS + _SPATIAL)


# Windows start three columns and two rows inside each raster, between pixel borders.
_WINDOWS = """
windows as (
  select *, 500000 + 1000 * cast(substr(seed_id, 6) as bigint) + 33e0 as minx, 4970000 - 22e0 as maxy from seeds),
cut as (
  select o.* replace (w.seed_id as seed_id, cast(floor((w.maxy - y) / 10) as int) as "row",
    cast(floor((x - w.minx) / 10) as int) as col)
  from obs o join windows w on x > w.minx and x < w.minx + 100 and y < w.maxy and y > w.maxy - 100)"""


@query(
    "seed_features_from_windows",
    _seed_sql(PARAMS)
    .replace("chosen as (\n  select * from obs", _WINDOWS.strip() + ",\nchosen as (\n  select * from cut"),
)
def seed_features_from_windows(spark: SparkSession, sf: str) -> DataFrame:
    """From scenes without seeds: windows are cut, gridded and summarised in one plan."""
    k = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint")
    windows = derived.seeds(spark, sf).select(
        "seed_id", "lat", "lon", (500000 + 1000 * k + F.lit(33.0)).alias("minx"), F.lit(4970000 - 122.0).alias("miny"),
        (500000 + 1000 * k + F.lit(133.0)).alias("maxx"), F.lit(4970000 - 22.0).alias("maxy"),
    )
    scenes = derived.placed_obs(spark, sf).drop("seed_id", "row", "col")
    run = points.features_from_windows(scenes, windows, PARAMS)
    return round_columns(run.features, _SPATIAL + _COUNT_STATS)


# B11 and B12 as pixels of 20 m: the smallest values of each square of four.
_COARSE = """
joined as (
  select * replace (
    min(B11) over (partition by seed_id, acq_date, "row" // 2, col // 2) as B11,
    min(B12) over (partition by seed_id, acq_date, "row" // 2, col // 2) as B12)
  from daily)"""


@query(
    "seed_features_two_resolutions",
    q.with_(q.OBS, q.SEEDS, q.daily(), _COARSE, q.indexed("joined"), q.pixels(0.2), q.seed_stats(2))
    + "select s.seed_id, coalesce(n_pixels, 0) as n_pixels, coalesce(n_pixels_with_min_obs, 0) as n_pixels_with_min_obs, "
    + ", ".join(sql_rounded(f'"{c}"', c) for c in _COUNT_STATS + _SPATIAL)
    + " from seeds s left join stats t on s.seed_id = t.seed_id where s.seed_id in (select seed_id from obs)",
)
def seed_features_two_resolutions(spark: SparkSession, sf: str) -> DataFrame:
    """20 m bands brought to the 10 m grid of the windows and joined with the others."""
    k = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint")
    x0 = 500000 + 1000 * k
    # observations meet by squares of four cells, so that the pixels of both resolutions come from one shuffle
    square = {"r": F.floor(F.col("row") / 2), "c": F.floor(F.col("col") / 2)}
    met = derived.scene_obs(spark, sf).withColumns(square).repartition("seed_id", "acq_date", *square)
    daily = last_of_day(met, keys=(*PIXEL_KEYS, *square))

    def pixel(res: float, down: int, right: int, values: dict[str, str]) -> Column:
        bands = [(F.col(values[b]) if b in values else F.lit(None).cast("double")).alias(b) for b in BANDS]
        return F.struct(F.lit(res).alias("res"), F.lit(down).alias("down"), F.lit(right).alias("right"), *bands)

    # the four cells of a square as columns of fixed width, beside its smallest coarse values
    cells = [(i, j, {b: f"{b}_{i}{j}" for b in BANDS[:4]}) for i in (0, 1) for j in (0, 1)]
    at = lambda i, j: (F.col("row") % 2 == i) & (F.col("col") % 2 == j)
    held = [F.max(F.when(at(i, j), F.col(b))).alias(name) for i, j, names in cells for b, name in names.items()]
    squares = daily.groupBy("seed_id", "acq_date", *square).agg(*held, *[F.min(b).alias(b) for b in BANDS[4:]])
    fine = [F.when(F.coalesce(*names.values()).isNotNull(), pixel(10.0, i, j, names)) for i, j, names in cells]
    coarse = pixel(20.0, 0, 0, {b: b for b in BANDS[4:]})
    # places are computed after the pixels are listed, so that the code that lists them stays small
    corner = [(x0 + 20 * F.col("c")).cast("double").alias("left"), (4970000 - 20 * F.col("r")).cast("double").alias("top")]
    listed = squares.select("acq_date", *corner, F.inline(F.array(coarse, *fine))).filter(F.col("res").isNotNull())
    pieces = listed.select(
        F.lit(1).alias("scene_idx"), F.lit(0).alias("cloud_cover"), "acq_date",
        (F.col("left") + F.col("res") * (F.col("right") + 0.5)).alias("x"),
        (F.col("top") - F.col("res") * (F.col("down") + 0.5)).alias("y"), "res", *BANDS,
    )
    windows = derived.seeds(spark, sf).select(
        "seed_id", "lat", "lon", x0.cast("double").alias("minx"), F.lit(4969900.0).alias("miny"),
        (x0 + F.lit(100.0)).alias("maxx"), F.lit(4970000.0).alias("maxy"),
    )
    run = points.features_from_pieces(pieces, 20.0, windows, Params())
    shown = run.features.select("seed_id", "n_pixels", "n_pixels_with_min_obs", *_COUNT_STATS, *_SPATIAL)
    return round_columns(shown, _SPATIAL + _COUNT_STATS)


# A shift of many digits: no value of few decimals comes to lie on a border of rounding.
_LONG_SHIFT = "1.2345678917e-7"
_OFFSET = ", ".join(f'round("{c}" + {_LONG_SHIFT}, 6) as "{c}"' for c in _SPATIAL + _COUNT_STATS)

# The second run has other parameters and sees the seeds of one parity only.
_RERUN = Params(max_cloud=40)
_FIRST, _SECOND = (f"select * from ({_seed_sql(p)})" for p in (Params(), _RERUN))
_EVEN = "cast(substr(seed_id, 6) as bigint) % 2 = 0"


@query(
    "rerun_features",
    f"select * replace ({_OFFSET}) from ({_FIRST} where not ({_EVEN}) union all {_SECOND} where {_EVEN})",
)
def rerun_features(spark: SparkSession, sf: str) -> DataFrame:
    """What readers see after a second run over half of the seeds: each seed's last run."""
    out = f"{spark.conf.get('spark.checkpoint.dir')}/rerun-{uuid.uuid4().hex}"
    obs, seeds = derived.scene_obs(spark, sf), derived.seeds(spark, sf)
    even = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint") % 2 == 0
    batch.run_batch(obs, seeds, Params(), out)
    batch.run_batch(obs.filter(even), seeds.filter(even), _RERUN, out)
    seen = runs.published(spark, out, "seed_features")
    chosen = {*_SPATIAL, *_COUNT_STATS}
    return seen.selectExpr(
        *[f"round(`{c}` + {_LONG_SHIFT}D, 6) as `{c}`" if c in chosen else f"`{c}`" for c in seen.columns]
    )


@query(
    "seeds_without_clear_scenes",
    q.with_(q.OBS, q.SEEDS)
    + "select seed_id, lat, lon, 'no tiles' as error from seeds "
    "where seed_id not in (select seed_id from obs where cloud_cover <= 2 and B12 >= 0.17)",
)
def seeds_without_clear_scenes(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine of seeds left without any observation by the scene filters."""
    seeds = derived.seeds(spark, sf)
    obs = derived.scene_obs(spark, sf).filter((F.col("cloud_cover") <= 2) & (F.col("B12") >= 0.17))
    return error_table(seeds, [missing_errors(seeds, obs)])
