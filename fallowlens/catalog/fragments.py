"""SQL fragments: the derived tables and the stages of the feature computation."""

from __future__ import annotations

from fallowlens.schemas import BANDS, INDICES, STATS, temporal_names

TARGETS = BANDS + INDICES

OBS = """
counted as (
  select *, l_linenumber = 7 and l_returnflag = 'R' as nod,
    cast(round(l_discount * 100) as int) as di, cast(round(l_tax * 100) as int) as ti,
    cast(l_quantity as int) as q
  from lineitem),
obs as (
  select printf('seed_%04d', l_suppkey) as seed_id,
    cast(l_partkey % 10 as int) as "row", cast((l_partkey // 10) % 10 as int) as col,
    date '2024-06-01' + cast(date_diff('day', date '1992-01-01', cast(l_shipdate as date)) % 30 as int) as acq_date,
    (((l_orderkey * 8 + l_linenumber) * 64 + case when nod then 0 else q end) * 16
      + case when nod then 0 else di end) * 16 + case when nod then 0 else ti end as scene_idx,
    q * 2 as cloud_cover,
    case when nod then 0e0 else (300 + 50 * ti) / 1e4 end as B02,
    case when nod then 0e0 else (400 + 25 * (di + ti)) / 1e4 end as B03,
    case when nod then 0e0 else (1003 + 100 * di) / 1e4 end as B04,
    case when nod then 0e0 else (600 + 40 * q) / 1e4 end as B08,
    case when nod then 0e0 else (1000 + 50 * q) / 1e4 end as B11,
    case when nod then 0e0 else (800 + l_orderkey % 1000) / 1e4 end as B12,
    500000 + 1000 * l_suppkey + 10 * (cast((l_partkey // 10) % 10 as int) + 0.5e0) as x,
    4970000 - 10 * (cast(l_partkey % 10 as int) + 0.5e0) as y
  from counted)"""

SEEDS = """
seeds as (
  select printf('seed_%04d', s_suppkey) as seed_id,
    44 + (s_suppkey % 100) / 1e2 as lat, 8 + (s_suppkey % 50) / 25e0 as lon, s_acctbal as balance
  from supplier)"""

NDVI = "case when B08 + B04 <> 0 then (B08 - B04) / (B08 + B04) end"
_TERM = "(power(2 * B08 + 1, 2) - 8 * (B08 - B04))"

INDEX_SQL = {
    "NDVI": NDVI,
    "NDMI": "case when B08 + B11 <> 0 then (B08 - B11) / (B08 + B11) end",
    "NDWI": "case when B03 + B08 <> 0 then (B03 - B08) / (B03 + B08) end",
    "NBR": "case when B08 + B12 <> 0 then (B08 - B12) / (B08 + B12) end",
    "MSAVI": f"(2 * B08 + 1 - sqrt(case when {_TERM} < 0 then 0 else {_TERM} end)) / 2",
    "EVI": "case when B08 + 6 * B04 - 7.5e0 * B02 + 1 <> 0 "
    "then 2.5e0 * (B08 - B04) / (B08 + 6 * B04 - 7.5e0 * B02 + 1) end",
}


def selected(max_cloud: int, start: str = "2024-06-01", end: str = "2024-06-30") -> str:
    """CTE ``chosen``: observations after the time and cloud filters."""
    return f"""
chosen as (
  select * from obs
  where acq_date >= date '{start}' and acq_date <= date '{end}' and cloud_cover <= {max_cloud})"""


def daily(source: str = "obs") -> str:
    """CTE ``daily``: the last acquisition of each pixel and day."""
    return f"""
daily as (
  select * exclude (rn) from (
    select *, row_number() over (
      partition by seed_id, "row", col, acq_date order by scene_idx desc) as rn
    from {source})
  where rn = 1)"""


def indexed(source: str = "daily") -> str:
    """CTE ``indexed``: the six indices appended."""
    cols = ", ".join(f"{sql} as {name}" for name, sql in INDEX_SQL.items())
    return f"\nindexed as (select *, {cols} from {source})"


def pixels(threshold: float, source: str = "indexed") -> str:
    """CTE ``pixels``: statistics of bare pixels, unmasked, with pixel centres."""
    fn = {"median": "median", "mean": "avg", "std": "stddev_samp"}
    cols = ", ".join(f'{fn[s]}({c}) as "{c}_{s}_bs"' for c in TARGETS for s in STATS)
    return f"""
pixels as (
  select seed_id, "row", col, x, y, {cols}, count(*) as n_obs_baresoil
  from {source} where NDVI < {threshold}
  group by seed_id, "row", col, x, y)"""


def seed_stats(min_obs: int) -> str:
    """CTE ``stats``: per-seed statistics over the pixels with enough observations."""
    fn = {"median": "median", "mean": "avg", "std": "stddev_pop"}
    cols = ", ".join(
        f'{fn[s]}("{c}") filter (n_obs_baresoil >= {min_obs}) as "{c}_space_{s}"'
        for c in temporal_names()
        for s in STATS
    )
    return f"""
stats as (
  select seed_id, count(*) as n_pixels,
    count(*) filter (n_obs_baresoil >= {min_obs}) as n_pixels_with_min_obs,
    avg(n_obs_baresoil) as mean_n_obs_baresoil,
    cast(median(n_obs_baresoil) as double) as median_n_obs_baresoil, {cols}
  from pixels group by seed_id)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"
