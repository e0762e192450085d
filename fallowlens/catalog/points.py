"""Survey points: projection, windows, range join, names and finished work."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.functions import geo
from fallowlens.functions.naming import mosaic_name, point_name
from fallowlens.operators.windows import dealt_window_join, window_join
from fallowlens.schemas import Params
from fallowlens.sources import derived
from fallowlens.sources.tables import with_seed_ids
from fallowlens.streaming.incremental import skip_done, with_work_key


def _utm_sql(meridian: float) -> str:
    """CTE ``utm``: easting and northing of ``seeds`` by the same series."""
    n = geo.WGS84_F / (2 - geo.WGS84_F)
    k = geo.UTM_SCALE * geo.WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    ecc = 2 * math.sqrt(n) / (1 + n)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    )
    east = " + ".join(
        f"{a!r}::double * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alpha, 1)
    )
    north = " + ".join(
        f"{a!r}::double * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alpha, 1)
    )
    return f"""
conformal as (
  select *, sinh(atanh(sin(radians(lat))) - {ecc!r}::double * atanh({ecc!r}::double * sin(radians(lat)))) as t,
    radians(lon - {meridian}) as dlon
  from seeds),
angles as (
  select *, atan2(t, cos(dlon)) as xi, atanh(sin(dlon) / sqrt(1 + t * t)) as eta from conformal),
utm as (
  select *, 500000e0 + {k!r}::double * (eta + {east}) as ux, {k!r}::double * (xi + {north}) as uy
  from angles)"""


_EDGES = ", ".join(
    sql_rounded(e, name, 4)
    for e, name in (("ux - 50", "minx"), ("uy - 50", "miny"), ("ux + 50", "maxx"), ("uy + 50", "maxy"))
)


@query(
    "utm_window",
    q.with_(q.SEEDS, _utm_sql(9.0)) + f"select seed_id, {_EDGES}, 32632 as epsg from utm",
)
def utm_window(spark: SparkSession, sf: str) -> DataFrame:
    df = geo.window_around(derived.seeds(spark, sf), 100.0, 32632)
    return round_columns(df.drop("lat", "lon", "transform"), ["minx", "miny", "maxx", "maxy"], 4)


@query(
    "utm_window_next_zone",
    q.with_(q.SEEDS, _utm_sql(15.0)) + f"select seed_id, {_EDGES}, 32633 as epsg from utm",
)
def utm_window_next_zone(spark: SparkSession, sf: str) -> DataFrame:
    df = geo.window_around(derived.seeds(spark, sf), 100.0, 32633)
    return round_columns(df.drop("lat", "lon", "transform"), ["minx", "miny", "maxx", "maxy"], 4)


_WINDOWS = """
windows as (
  select seed_id, cx - 35 as minx, cy - 35 as miny, cx + 35 as maxx, cy + 35 as maxy from (
    select printf('seed_%04d', s_suppkey) as seed_id,
      500050e0 + 1000 * (s_suppkey - s_suppkey % 4) + 20 * (s_suppkey % 3) as cx,
      4969950e0 - 20 * (s_suppkey % 2) as cy
    from supplier))"""


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    cx = F.lit(500050.0) + 1000 * (k - k % 4) + 20 * (k % 3)
    cy = F.lit(4969950.0) - 20 * (k % 2)
    return derived.table(spark, sf, "supplier").select(
        derived.seed_name(k).alias("seed_id"),
        (cx - 35).alias("minx"),
        (cy - 35).alias("miny"),
        (cx + 35).alias("maxx"),
        (cy + 35).alias("maxy"),
    )


@query(
    "window_join",
    q.with_(q.OBS, _WINDOWS)
    + 'select w.seed_id, o."row", o.col, o.scene_idx, o.x, o.y, o.B08 '
    "from obs o join windows w on o.x >= w.minx and o.x < w.maxx and o.y >= w.miny and o.y < w.maxy",
)
def window_join_query(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping windows, some shared, with edges on pixel centres."""
    obs = derived.placed_obs(spark, sf).select("row", "col", "scene_idx", "x", "y", "B08")
    return window_join(obs, _windows(spark, sf), 70.0)


@query(
    "dealt_window_join",
    q.with_(q.OBS, _WINDOWS)
    + 'select w.seed_id, o."row", o.col, o.scene_idx, o.x, o.y, o.B08 '
    "from obs o join windows w on o.x >= w.minx and o.x < w.maxx and o.y >= w.miny and o.y < w.maxy",
)
def dealt_window_join_query(spark: SparkSession, sf: str) -> DataFrame:
    """The range join on cells along a curve, dense ones in parts of 50 observations."""
    obs = derived.placed_obs(spark, sf).select("row", "col", "scene_idx", "x", "y", "B08")
    return dealt_window_join(obs, _windows(spark, sf), 70.0, 50)


_BOTH_ZONES = (
    "select seed_id, minx, miny, maxx, maxy, epsg from ("
    + q.with_(q.SEEDS, _utm_sql(9.0)) + f"select seed_id, {_EDGES}, 32632 as epsg from utm"
    + ") union all select seed_id, minx, miny, maxx, maxy, epsg from ("
    + q.with_(q.SEEDS, _utm_sql(15.0)) + f"select seed_id, {_EDGES}, 32633 as epsg from utm)"
)


@query("utm_windows_in_zones", _BOTH_ZONES)
def utm_windows_in_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Windows in the zones of the rasters that a point may lie in; the third one is too far."""
    df = geo.windows_in_zones(derived.seeds(spark, sf).select("seed_id", "lat", "lon"), 100.0, [32632, 32633, 32635, 32732])
    return round_columns(df.drop("lat", "lon"), ["minx", "miny", "maxx", "maxy"], 4)


@query(
    "window_join_two_zones",
    q.with_(q.OBS, _WINDOWS)
    + 'select w.seed_id, z as epsg, o.scene_idx, o.x, o.y, o.B08 from obs o '
    "join (select *, unnest([32632, 32633]) as z from windows) w "
    "on z = 32632 + o.scene_idx % 2 and (z = 32632 or cast(substr(w.seed_id, 6) as bigint) % 3 > 0) "
    "and o.x >= w.minx and o.x < w.maxx and o.y >= w.miny and o.y < w.maxy",
)
def window_join_two_zones(spark: SparkSession, sf: str) -> DataFrame:
    """Rasters of two zones with the same coordinates; a third of the points has a window in one only."""
    both = _windows(spark, sf).withColumn("epsg", F.explode(F.array(F.lit(32632), F.lit(32633))))
    third = F.regexp_extract("seed_id", r"(\d+)$", 1).cast("bigint") % 3 == 0
    windows = both.filter(~third | (F.col("epsg") == 32632))
    obs = derived.placed_obs(spark, sf).withColumn("epsg", (32632 + F.col("scene_idx") % 2).cast("int"))
    cut = window_join(obs.select("epsg", "scene_idx", "x", "y", "B08"), windows, 70.0, zone="epsg")
    return cut.select("seed_id", "epsg", "scene_idx", "x", "y", "B08")


@query(
    "point_names",
    q.with_(q.SEEDS)
    + "select seed_id, replace(concat('point_', printf('%.6f', lat), '_', printf('%.6f', lon)), "
    "'.', 'p') as point, 100 as window_m, '2024-06-01_2024-06-30' as \"interval\" from seeds",
)
def point_names(spark: SparkSession, sf: str) -> DataFrame:
    keyed = with_work_key(derived.seeds(spark, sf), Params())
    return keyed.select("seed_id", "point", "window_m", "interval")


@query(
    "mosaic_names",
    "select o_orderkey, concat_ws('_', lower(o_orderpriority), "
    "strftime(o_orderdate, '%Y-%m-%d'), strftime(o_orderdate + interval 30 day, '%Y-%m-%d'), "
    "case when o_orderkey % 2 = 0 then 'B02-B03-B04-B08' end, "
    "case when o_custkey % 3 <> 0 then concat(cast(o_custkey % 3 * 256 as varchar), 'x512') end, "
    "case when o_orderstatus <> 'O' then lower(o_orderstatus) end) as mosaic from orders",
)
def mosaic_names(spark: SparkSession, sf: str) -> DataFrame:
    orders = derived.table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    bands = F.array(*[F.lit(b) for b in ("B02", "B03", "B04", "B08")])
    return orders.select(
        "o_orderkey",
        mosaic_name(
            F.lower("o_orderpriority"),
            F.date_format(day, "yyyy-MM-dd"),
            F.date_format(F.date_add(day, 30), "yyyy-MM-dd"),
            F.when(F.col("o_orderkey") % 2 == 0, bands),
            (F.col("o_custkey") % 3 * 256),
            F.lit(512),
            F.when(F.col("o_orderstatus") != "O", F.lower("o_orderstatus")),
        ).alias("mosaic"),
    )


@query(
    "skip_done",
    q.with_(q.SEEDS)
    + "select seed_id, lat, lon from seeds where (lat, lon) not in ("
    "select 44 + (s_suppkey % 100) / 1e2, 8 + (s_suppkey % 50) / 25e0 from supplier "
    "where s_acctbal > 8000 and s_nationkey <> 0)",
)
def skip_done_query(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds whose point has no finished extraction yet.

    The manifest has a tile per unit of balance above 8000; nation 0 lacks its bands.
    """
    supplier = derived.table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    points = supplier.select(
        derived.seed_name(k).alias("seed_id"),
        (44 + (k % 100) / F.lit(1e2)).alias("lat"),
        (8 + (k % 50) / F.lit(25.0)).alias("lon"),
        F.ceil(F.greatest(F.col("s_acctbal") - 8000, F.lit(0))).alias("n_tiles"),
        F.when(F.col("s_nationkey") != 0, F.lit("B02")).alias("bands"),
    )
    manifest = with_work_key(points, Params())
    return skip_done(derived.seeds(spark, sf).drop("transform"), manifest, Params())


@query(
    "seed_numbering",
    "select printf('seed_%04d', row_number() over (order by s_suppkey) - 1) as seed_id, "
    "44 + (s_suppkey % 100) / 1e2 as lat, 8 + (s_suppkey % 50) / 25e0 as lon from supplier",
)
def seed_numbering(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds without ids, numbered by their position in the file."""
    return with_seed_ids(
        derived.table(spark, sf, "supplier").select(
            (44 + (F.col("s_suppkey") % 100) / F.lit(1e2)).alias("lat"),
            (8 + (F.col("s_suppkey") % 50) / F.lit(25.0)).alias("lon"),
        )
    )


@query(
    "distinct_points",
    q.with_(q.SEEDS)
    + "select replace(concat('point_', printf('%.6f', lat), '_', printf('%.6f', lon)), '.', 'p') "
    "as point, count(*) as n_seeds from seeds group by 1",
)
def distinct_points(spark: SparkSession, sf: str) -> DataFrame:
    """Seeds per extraction: those at one point share it."""
    named = derived.seeds(spark, sf).select(point_name(F.col("lat"), F.col("lon")).alias("point"))
    return named.groupBy("point").agg(F.count("*").alias("n_seeds"))
