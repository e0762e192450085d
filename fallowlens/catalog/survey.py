"""Survey tables and the training table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fallowlens.catalog import fragments as q
from fallowlens.catalog.features import PARAMS
from fallowlens.catalog.registry import query, round_columns, sql_rounded
from fallowlens.operators import survey as s
from fallowlens.plans import batch
from fallowlens.plans.seeds import prepare_seeds
from fallowlens.plans.training import training_table
from fallowlens.schemas import spatial_names, temporal_names
from fallowlens.sources import derived

_STATS = spatial_names(temporal_names())

COORDS = """
coords as (
  select o_orderkey as seq,
    case when o_custkey % 17 = 0 then 'NE' when o_custkey % 19 = 0 then 'nan'
         when o_orderkey % 3 = 0 then concat(cast(o_custkey as varchar), '.0')
         else cast(o_custkey as varchar) end as POINT_ID,
    case when o_orderkey % 7 = 0 then null
         else 36 + (o_custkey % 1000) / 1e2 + (o_orderkey % 4) / 1e4 end as GPS_LAT,
    case when o_orderkey % 11 = 0 then null else 7 + (o_custkey % 500) / 1e2 end as GPS_LONG
  from orders)"""
CLEAN = """
cleaned as (
  select seq, regexp_replace(POINT_ID, '\\.0$', '') as POINT_ID, GPS_LAT, GPS_LONG from coords
  where POINT_ID is not null and upper(POINT_ID) not in ('NE', 'NAN'))"""
LOOKUP = """
lookup as (
  select POINT_ID, GPS_LAT, GPS_LONG from (
    select *, row_number() over (partition by POINT_ID order by seq) as rn from cleaned
    where GPS_LAT is not null and GPS_LONG is not null)
  where rn = 1)"""
JOINED = """
joined as (
  select v.POINT_ID, OC, NUTS, GPS_LAT as lat, GPS_LONG as lon
  from (select cast(c_custkey as varchar) as POINT_ID, c_acctbal as OC, c_nationkey as NUTS from customer) v
  left join lookup l on v.POINT_ID = l.POINT_ID)"""
SURVEY = (COORDS, CLEAN, LOOKUP, JOINED)


@query(
    "latitude_range_of_texts",
    q.with_(COORDS)
    + "select min(GPS_LAT) as lat_min, max(GPS_LAT) as lat_max from coords where seq % 5 <> 0",
)
def latitude_range_of_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Extent of latitudes given as text, among texts that are no finite number."""
    coords = derived.survey_coords(spark, sf)
    text = F.when(F.col("seq") % 10 == 0, F.lit("nan")).when(F.col("seq") % 5 == 0, F.lit("?"))
    return s.latitude_range(coords.withColumn("GPS_LAT", F.coalesce(text, F.col("GPS_LAT").cast("string"))))


def _lookup(spark: SparkSession, sf: str) -> DataFrame:
    return s.coord_lookup(s.clean_ids(derived.survey_coords(spark, sf)))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return s.join_coordinates(derived.survey_values(spark, sf), _lookup(spark, sf))


@query("clean_ids", q.with_(COORDS, CLEAN) + "select seq, POINT_ID, GPS_LAT, GPS_LONG from cleaned")
def clean_ids(spark: SparkSession, sf: str) -> DataFrame:
    return s.clean_ids(derived.survey_coords(spark, sf))


@query("coord_lookup", q.with_(COORDS, CLEAN, LOOKUP) + "select POINT_ID, GPS_LAT, GPS_LONG from lookup")
def coord_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return _lookup(spark, sf)


@query("survey_join", q.with_(*SURVEY) + "select POINT_ID, OC, NUTS, lat, lon, POINT_ID as seed_id from joined")
def survey_join(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_seeds(derived.survey_values(spark, sf), derived.survey_coords(spark, sf))


@query(
    "survey_id_counts",
    q.with_(COORDS, CLEAN)
    + "select (select count(*) from coords) as n_rows, count(*) as n_valid, "
    "count(distinct POINT_ID) filter (GPS_LAT is not null and GPS_LONG is not null) as n_lookup "
    "from cleaned",
)
def survey_id_counts(spark: SparkSession, sf: str) -> DataFrame:
    return s.id_counts(derived.survey_coords(spark, sf))


@query(
    "survey_missing",
    q.with_(*SURVEY) + "select count(*) as n_rows, count(*) filter (lat is null) as n_missing from joined",
)
def survey_missing(spark: SparkSession, sf: str) -> DataFrame:
    return s.missing_coordinates(_joined(spark, sf))


@query(
    "survey_unmatched",
    q.with_(*SURVEY) + "select POINT_ID from joined where lat is null order by POINT_ID limit 10",
)
def survey_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return s.unmatched_head(_joined(spark, sf))


@query(
    "latitude_range",
    q.with_(COORDS, CLEAN, LOOKUP)
    + f"select {sql_rounded('min(GPS_LAT)', 'lat_min')}, {sql_rounded('max(GPS_LAT)', 'lat_max')} from lookup",
)
def latitude_range(spark: SparkSession, sf: str) -> DataFrame:
    """Latitudes come as text here, as a table of mixed cells gives them."""
    text = _lookup(spark, sf).withColumn("GPS_LAT", F.col("GPS_LAT").cast("string"))
    return round_columns(s.latitude_range(text), ["lat_min", "lat_max"])


_DESCRIBED = ("mean", "std", "min", "q25", "q50", "q75", "max", "top")


def _describe_sql(column: str) -> str:
    return (
        f"select '{column}' as \"column\", count({column}) as \"count\", "
        f'count(distinct {column}) as "unique", '
        f"round((select {column} from lookup group by {column} order by count(*) desc, {column} limit 1), 10) + 0e0 as \"top\", "
        f'(select count(*) from lookup group by {column} order by count(*) desc limit 1) as "freq", '
        + ", ".join(
            sql_rounded(e, name)
            for e, name in (
                (f"avg({column})", "mean"),
                (f"stddev_samp({column})", "std"),
                (f"min({column})", "min"),
                (f"quantile_cont({column}, 0.25)", "q25"),
                (f"quantile_cont({column}, 0.5)", "q50"),
                (f"quantile_cont({column}, 0.75)", "q75"),
                (f"max({column})", "max"),
            )
        )
        + " from lookup"
    )


@query(
    "lookup_describe",
    q.with_(COORDS, CLEAN, LOOKUP) + _describe_sql("GPS_LAT") + " union all " + _describe_sql("GPS_LONG"),
)
def lookup_describe(spark: SparkSession, sf: str) -> DataFrame:
    return round_columns(s.describe(_lookup(spark, sf), ["GPS_LAT", "GPS_LONG"]), _DESCRIBED)


_TEXTS = {"status": "o_orderstatus", "priority": "case when o_custkey % 4 <> 0 then o_orderpriority end", "customer": "o_custkey"}


@query(
    "describe_texts",
    " union all ".join(
        f"select '{c}' as \"column\", count(v)::bigint as count, count(distinct v)::bigint as \"unique\", "
        f"(select v from (select cast({e} as varchar) as v from orders) where v is not null group by v order by count(*) desc, v limit 1) as top, "
        f"(select count(*)::bigint from (select cast({e} as varchar) as v from orders) where v is not null group by v order by count(*) desc, v limit 1) as freq "
        f"from (select cast({e} as varchar) as v from orders)"
        for c, e in _TEXTS.items()
    ),
)
def describe_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Count, unique, top and freq of text columns, one with missing values."""
    return s.describe_texts(derived.table(spark, sf, "orders").selectExpr(*(f"{e} as {c}" for c, e in _TEXTS.items())), list(_TEXTS))


@query(
    "training_table",
    q.with_(
        q.OBS, q.SEEDS, q.selected(PARAMS.max_cloud), q.daily("chosen"), q.indexed(), q.pixels(0.2),
        q.seed_stats(2), *SURVEY,
    )
    + "select s.seed_id, s.lat, s.lon, coalesce(n_pixels, 0) as n_pixels, "
    + ", ".join(sql_rounded(f'"{c}"', c) for c in _STATS)
    + ", OC, NUTS from seeds s left join stats t on s.seed_id = t.seed_id "
    "join joined j on s.seed_id = printf('seed_%04d', cast(j.POINT_ID as bigint)) "
    "where s.seed_id in (select seed_id from chosen)",
)
def training(spark: SparkSession, sf: str) -> DataFrame:
    """Seed features with laboratory values; survey point n belongs to seed n."""
    survey = prepare_seeds(derived.survey_values(spark, sf), derived.survey_coords(spark, sf))
    survey = survey.withColumn("seed_id", derived.seed_name(F.col("POINT_ID")))
    run = batch.seed_features(derived.scene_obs(spark, sf), derived.seeds(spark, sf), PARAMS)
    table = training_table(run.features.select("seed_id", "lat", "lon", "n_pixels", *_STATS), survey)
    return round_columns(table.drop("POINT_ID"), _STATS)
