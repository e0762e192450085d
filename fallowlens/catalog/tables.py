"""Table profiles and duplicate checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.operators import profiles, quality
from fallowlens.schemas import BANDS
from fallowlens.sources import derived

# A column's numbers, and how its smallest and largest value are written.
_NUMBERS = ("row", "col", "scene_idx", "cloud_cover", *BANDS)


def _profile_sql(c: str) -> str:
    number = c in _NUMBERS
    fact = lambda expr, name: sql_rounded(expr, name, 3) if number else f"cast(null as double) as {name}"
    value = f'cast("{c}" as double)'
    return (
        f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count(\"{c}\") as nulls, "
        + f'count(distinct "{c}") as "distinct", '
        + ", ".join(
            fact(e, n)
            for e, n in (
                (f"min({value})", "low"), (f"max({value})", "high"), (f"avg({value})", "mean"),
                (f"stddev_samp({value})", "std"), (f"median({value})", "median"),
            )
        )
        + (", null" if number else f', cast(min("{c}") as varchar) || \' to \' || cast(max("{c}") as varchar)')
        + " as extent from obs"
    )


@query(
    "table_profile",
    q.with_(q.OBS) + " union all ".join(_profile_sql(c) for c in ("seed_id", "acq_date", *_NUMBERS)),
)
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Exact facts of all columns of the observation table."""
    obs = derived.scene_obs(spark, sf)
    facts = quality.table_profile(obs, approximate=False).drop("type").join(quality.exact_profile(obs), "column")
    number = F.col("column").isin(*_NUMBERS)
    typed = facts.withColumn(
        "extent", F.when(~number, F.concat_ws(" to ", "low", "high"))
    ).withColumns({c: F.when(number, F.col(c).try_cast("double")) for c in ("low", "high")})
    return round_columns(typed, ["low", "high", "mean", "std", "median"], 3)


_MERGED = (("cloud_cover", "cloud_cover"), ("clear", "case when cloud_cover <= 60 then B08 end"), ("B04", "B04"))


@query(
    "merged_profile",
    q.with_(q.OBS)
    + " union all ".join(
        f"select '{c}' as \"column\", count(*) as n_rows, count(*) - count({e}) as nulls, "
        + ", ".join(sql_rounded(f"{f}(cast({e} as double))", n, 6) for f, n in (("min", "low"), ("max", "high"), ("avg", "mean"), ("stddev_samp", "std")))
        + " from obs"
        for c, e in _MERGED
    ),
)
def merged_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Exact facts of a profile that was added up from the sketches of each day's rows."""
    obs = derived.scene_obs(spark, sf).select(
        "acq_date", "cloud_cover", F.when(F.col("cloud_cover") <= 60, F.col("B08")).alias("clear"), "B04"
    )
    found = profiles.merged_profile(profiles.profile_sketches(obs, ["acq_date"]))
    facts = found.select("column", F.col("rows").alias("n_rows"), "nulls", "low", "high", "mean", "std")
    return round_columns(facts, ["low", "high", "mean", "std"], 6)


@query(
    "top_values",
    q.with_(q.OBS)
    + "select cloud_cover as value, count(*) as n from obs group by 1 order by n desc, value limit 5",
)
def top_values(spark: SparkSession, sf: str) -> DataFrame:
    return quality.top_values(derived.scene_obs(spark, sf), "cloud_cover", 5)


@query(
    "duplicate_ids",
    "select cast(o_custkey as varchar) as POINT_ID, count(*) as n_rows from orders "
    "group by o_custkey having count(*) > 1",
)
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = derived.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("POINT_ID")
    )
    return quality.duplicate_keys(ids, "POINT_ID")
