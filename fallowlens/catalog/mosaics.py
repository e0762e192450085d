"""Scene selection, mosaics, resampling, same-day overwrite and composites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.operators import scenes
from fallowlens.plans.composite import aoi_composite, single_composite
from fallowlens.schemas import BANDS
from fallowlens.sources import derived

KEYS = 'seed_id, "row", col'
_BANDS = ", ".join(BANDS)
AOI = (502000.0, 4969930.0, 530055.0, 4969985.0)
AOI_SQL = "x >= 502000 and x < 530055 and y >= 4969930 and y < 4969985"


@query("last_of_day", q.with_(q.OBS, q.daily()) + f"select {KEYS}, acq_date, {_BANDS} from daily", date="acq_date")
def last_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.last_of_day(derived.scene_obs(spark, sf))


@query(
    "scene_filter",
    q.with_(q.OBS, q.selected(20, "2024-06-05", "2024-06-20"))
    + f"select {KEYS}, acq_date, scene_idx, cloud_cover, B04, B08 from chosen",
    date="acq_date",
)
def scene_filter(spark: SparkSession, sf: str) -> DataFrame:
    obs = derived.scene_obs(spark, sf)
    return scenes.select_scenes(obs, "2024-06-05", "2024-06-20", 20, ["B04", "B08"])


@query(
    "area_filter",
    q.with_(q.OBS) + f"select {KEYS}, scene_idx, x, y, B04, B08 from obs where {AOI_SQL}",
)
def area_filter(spark: SparkSession, sf: str) -> DataFrame:
    df = scenes.inside_bbox(derived.placed_obs(spark, sf), AOI)
    return scenes.project_bands(df, ["seed_id", "row", "col", "scene_idx", "x", "y"], ["B04", "B08"])


@query(
    "orbit_stack",
    q.with_(q.OBS) + f"select {KEYS}, acq_date, scene_idx, {_BANDS} from obs",
    date="acq_date",
)
def orbit_stack(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.orbit_stack(derived.scene_obs(spark, sf))


@query(
    "orbit_dates",
    q.with_(q.OBS)
    + "select seed_id, acq_date, count(distinct scene_idx) as n_scenes from obs "
    "group by seed_id, acq_date",
    date="acq_date",
)
def orbit_dates(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.orbit_dates(derived.scene_obs(spark, sf))


@query(
    "pixel_series",
    q.with_(q.OBS, q.daily())
    + f"select {KEYS}, count(*) as n_days, "
    "string_agg(strftime(acq_date, '%Y-%m-%d'), ',' order by acq_date) as days, "
    "string_agg(cast(cast(round(B08 * 10000) as bigint) as varchar), ',' order by acq_date) as b08 "
    f"from daily group by {KEYS}",
)
def pixel_series(spark: SparkSession, sf: str) -> DataFrame:
    stacked = scenes.pixel_series(scenes.last_of_day(derived.scene_obs(spark, sf)))
    days = F.transform("series", lambda s: F.date_format(s["acq_date"], "yyyy-MM-dd"))
    b08 = F.transform("series", lambda s: F.round(s["B08"] * 10000).cast("bigint").cast("string"))
    return stacked.select(
        "seed_id",
        "row",
        "col",
        F.size("series").cast("bigint").alias("n_days"),
        F.array_join(days, ",").alias("days"),
        F.array_join(b08, ",").alias("b08"),
    )


_MEDIANS = ", ".join(sql_rounded(f"median({b})", b) for b in BANDS)


@query("median_mosaic", q.with_(q.OBS) + f"select {KEYS}, {_MEDIANS} from obs group by {KEYS}")
def median_mosaic(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(scenes.median_mosaic(derived.scene_obs(spark, sf)), BANDS)


@query(
    "median_mosaic_any_size",
    q.with_(q.OBS) + f"select seed_id, {_MEDIANS} from obs group by seed_id",
)
def median_mosaic_any_size(spark: SparkSession, sf: str) -> DataFrame:
    """Medians of whole seeds, by bracketing instead of value maps."""
    obs = derived.scene_obs(spark, sf)
    return round_columns(scenes.median_mosaic(obs, keys=["seed_id"], quantised=False), BANDS)


def _clearest(source: str) -> str:
    return f"""
best as (
  select * exclude (rn) from (
    select *, row_number() over (partition by {KEYS}
      order by cloud_cover, acq_date desc, scene_idx desc) as rn
    from {source})
  where rn = 1)"""


@query(
    "least_cloud_mosaic",
    q.with_(q.OBS, _clearest("obs"))
    + f"select {KEYS}, cloud_cover, acq_date, {_BANDS} from best",
    date="acq_date",
)
def least_cloud_mosaic(spark: SparkSession, sf: str) -> DataFrame:
    return scenes.least_cloud_mosaic(derived.scene_obs(spark, sf))


@query(
    "single_composite",
    q.with_(q.OBS, q.selected(80, "2024-06-10", "2024-06-20"), _clearest("chosen"))
    + f"select {KEYS}, cloud_cover, acq_date, B02, B03, B04, B08 from best",
    date="acq_date",
)
def clearest_composite(spark: SparkSession, sf: str) -> DataFrame:
    obs = derived.scene_obs(spark, sf)
    return single_composite(obs, None, "2024-06-10", "2024-06-20", 80, ["B02", "B03", "B04", "B08"])


@query(
    "area_composite",
    q.with_(q.OBS, q.selected(20))
    + f"select {KEYS}, {', '.join(sql_rounded(f'median({b})', b) for b in ('B02', 'B03', 'B04', 'B08'))} "
    + f"from chosen where {AOI_SQL} group by {KEYS}",
)
def area_composite(spark: SparkSession, sf: str) -> DataFrame:
    obs = derived.placed_obs(spark, sf)
    bands = ["B02", "B03", "B04", "B08"]
    df = aoi_composite(obs, AOI, "2024-06-01", "2024-06-30", 20, bands)
    return round_columns(df, bands)


_TARGET_GRID = "\ntarget as (select r, c from range(0, 20) a(r), range(0, 20) b(c))"


@query(
    "resample_nearest",
    q.with_(q.OBS, q.daily(), _TARGET_GRID)
    + 'select seed_id, acq_date, cast(r as int) as "row", cast(c as int) as col, B11, B12 '
    'from daily join target on "row" = cast(floor((r + 0.5e0) * 10 / 20) as int) '
    "and col = cast(floor((c + 0.5e0) * 10 / 20) as int)",
    date="acq_date",
)
def resample_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """20 m pixels brought to a 10 m grid."""
    coarse = scenes.last_of_day(derived.scene_obs(spark, sf), ["B11", "B12"])
    return scenes.resample_nearest(coarse, 20.0, 10.0, (20, 20))


@query(
    "resample_coarser",
    q.with_(q.OBS, q.daily())
    + 'select seed_id, acq_date, cast(r as int) as "row", cast(c as int) as col, B04 '
    "from daily join (select r, c from range(0, 7) a(r), range(0, 7) b(c)) t "
    'on "row" = cast(floor((r + 0.5e0) * 15 / 10) as int) '
    "and col = cast(floor((c + 0.5e0) * 15 / 10) as int)",
    date="acq_date",
)
def resample_coarser(spark: SparkSession, sf: str) -> DataFrame:
    """10 m pixels sampled on a 15 m grid."""
    fine = scenes.last_of_day(derived.scene_obs(spark, sf), ["B04"])
    return scenes.resample_nearest(fine, 10.0, 15.0, (7, 7))
