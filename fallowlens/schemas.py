"""Column contracts, input schemas and run parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Band and index names, in the order every output follows.
BANDS = ("B02", "B03", "B04", "B08", "B11", "B12")
INDICES = ("NDVI", "NDMI", "NDWI", "NBR", "MSAVI", "EVI")
# Suffixes of the generated statistic columns.
STATS = ("median", "mean", "std")

PIXEL_KEYS = ("seed_id", "row", "col")
SEED_KEYS = ("seed_id", "seed_lat", "seed_lon")

SEEDS = T.StructType(
    [
        T.StructField("seed_id", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)

ERRORS = T.StructType(SEEDS.fields + [T.StructField("error", T.StringType())])

# One raster of one acquisition: data is band-major, row-major inside a band.
TILES = T.StructType(
    [
        T.StructField("seed_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("transform", T.ArrayType(T.DoubleType())),
        T.StructField("bands", T.ArrayType(T.StringType())),
        T.StructField("data", T.ArrayType(T.FloatType())),
    ]
)

# All acquisitions of one seed in one raster, date-major.
STACKED_TILES = T.StructType(
    [
        T.StructField("seed_id", T.StringType()),
        T.StructField("userdata", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("transform", T.ArrayType(T.DoubleType())),
        T.StructField("data", T.ArrayType(T.FloatType())),
    ]
)


@dataclass(frozen=True)
class Params:
    """Settings of one feature run.

    A seed's grid is as large as its rasters. ``size`` (width, height) declares it
    where that is known; pixels outside a declared grid are then errors.
    ``spread`` finds a seed's statistics without gathering its pixels in one task, for
    rasters of any size; the pixel table is then stored in ``spark.checkpoint.dir``.
    """

    window_m: float = 100.0
    dst_epsg: int = 32632
    size: tuple[int, int] | None = None
    start_date: str = "2024-06-01"
    end_date: str = "2024-06-30"
    bands: tuple[str, ...] = BANDS
    ndvi_threshold: float = 0.2
    min_obs: int = 2
    max_cloud: int = 80
    spread: bool = False

    @property
    def targets(self) -> tuple[str, ...]:
        return tuple(self.bands) + INDICES


def temporal_names(targets: tuple[str, ...] = BANDS + INDICES) -> list[str]:
    """Per-pixel statistic columns, e.g. ``B02_median_bs``."""
    return [f"{c}_{s}_bs" for c in targets for s in STATS]


def spatial_names(features: list[str]) -> list[str]:
    """Per-seed statistic columns, e.g. ``B02_median_bs_space_mean``."""
    return [f"{c}_space_{s}" for c in features for s in STATS]


def timeseries_columns(bands: tuple[str, ...] = BANDS) -> list[str]:
    return [*SEED_KEYS, "date", "row", "col", "x", "y", *bands, *INDICES, "is_baresoil"]


def pixel_columns(bands: tuple[str, ...] = BANDS) -> list[str]:
    return ["row", "col", "x", "y", *temporal_names(tuple(bands) + INDICES), "n_obs_baresoil"]


def seed_columns(bands: tuple[str, ...] = BANDS) -> list[str]:
    return [
        "seed_id",
        "lat",
        "lon",
        "n_pixels",
        "n_pixels_with_min_obs",
        "mean_n_obs_baresoil",
        "median_n_obs_baresoil",
        *spatial_names(temporal_names(tuple(bands) + INDICES)),
        "window_m",
        "start_date",
        "end_date",
        "ndvi_threshold",
        "max_cloud_coverage",
    ]


def _fields(names: list[str], kinds: dict[str, T.DataType]) -> T.StructType:
    """Doubles, but for the columns in ``kinds``."""
    return T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in names])


def timeseries_schema(bands: tuple[str, ...] = BANDS) -> T.StructType:
    kinds = {"seed_id": T.StringType(), "date": T.DateType(), "row": T.IntegerType(), "col": T.IntegerType(), "is_baresoil": T.BooleanType()}
    return _fields(timeseries_columns(bands), kinds)


def pixel_schema(bands: tuple[str, ...] = BANDS) -> T.StructType:
    kinds = {"seed_id": T.StringType(), "row": T.IntegerType(), "col": T.IntegerType(), "n_obs_baresoil": T.LongType()}
    return _fields([*SEED_KEYS, *pixel_columns(bands)], kinds)


def seed_schema(bands: tuple[str, ...] = BANDS) -> T.StructType:
    kinds = {"seed_id": T.StringType(), "n_pixels": T.LongType(), "n_pixels_with_min_obs": T.LongType(), "start_date": T.StringType(),
             "end_date": T.StringType(), "max_cloud_coverage": T.IntegerType()}
    return _fields(seed_columns(bands), kinds)
