"""Projection, windows, pixel centres and grid cells as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS 84 ellipsoid and universal transverse Mercator constants.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_EASTING = 500000.0
UTM_SOUTH_NORTHING = 10000000.0


def utm_zone(epsg: int) -> tuple[float, float]:
    """Central meridian in degrees and false northing of EPSG 326zz / 327zz."""
    hemisphere, zone = divmod(epsg, 100)
    if hemisphere not in (326, 327) or not 1 <= zone <= 60:
        raise ValueError(f"EPSG:{epsg} is not a WGS 84 UTM zone")
    return zone * 6.0 - 183.0, UTM_SOUTH_NORTHING if hemisphere == 327 else 0.0


def to_utm(lat: Column, lon: Column, epsg: int) -> tuple[Column, Column]:
    """Easting and northing in one zone."""
    meridian, northing0 = utm_zone(epsg)
    return _krueger(lat, lon, F.lit(meridian), F.lit(northing0))


def to_zone(lat: Column, lon: Column, epsg: Column) -> tuple[Column, Column]:
    """Easting and northing in the zone that each row names; NULL where it names none."""
    zone = epsg % 100
    known = F.floor(epsg / 100).isin(326, 327) & zone.between(1, 60)
    northing0 = F.when(epsg >= 32700, F.lit(UTM_SOUTH_NORTHING)).otherwise(F.lit(0.0))
    x, y = _krueger(lat, lon, zone * F.lit(6.0) - F.lit(183.0), northing0)
    return F.when(known, x), F.when(known, y)


def _krueger(lat: Column, lon: Column, meridian: Column, northing0: Column) -> tuple[Column, Column]:
    """Transverse Mercator by the Krueger series to third order."""
    n = WGS84_F / (2 - WGS84_F)
    radius = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    )
    ecc = 2 * math.sqrt(n) / (1 + n)

    sin_lat = F.sin(F.radians(lat))
    dlon = F.radians(lon - meridian)
    t = F.sinh(F.atanh(sin_lat) - ecc * F.atanh(ecc * sin_lat))
    xi = F.atan2(t, F.cos(dlon))
    eta = F.atanh(F.sin(dlon) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, start=1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    k = UTM_SCALE * radius
    return UTM_EASTING + k * east, northing0 + k * north


def project(lat: Column, lon: Column, src_epsg: int, dst_epsg: int) -> tuple[Column, Column]:
    """x and y in the target system; geographic coordinates come as (lat, lon)."""
    if src_epsg == dst_epsg:
        return lon, lat
    if src_epsg != 4326:
        raise ValueError("only geographic WGS 84 coordinates (EPSG:4326) can be projected")
    return to_utm(lat, lon, dst_epsg)


def window_around(
    df: DataFrame,
    size_m: float,
    dst_epsg: int = 32632,
    src_epsg: int = 4326,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Append the square window ``minx,miny,maxx,maxy,epsg`` around each point."""
    x, y = project(F.col(lat), F.col(lon), src_epsg, dst_epsg)
    half = size_m / 2.0
    kept = df.columns
    # the centre is a column of its own so that the series is evaluated once
    centred = df.select("*", x.alias("_cx"), y.alias("_cy"))
    return centred.select(
        *kept,
        (F.col("_cx") - half).alias("minx"),
        (F.col("_cy") - half).alias("miny"),
        (F.col("_cx") + half).alias("maxx"),
        (F.col("_cy") + half).alias("maxy"),
        F.lit(dst_epsg).alias("epsg"),
    )


def windows_in_zones(
    points: DataFrame, size_m: float, zones: list[int], lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """A square window around each point in every listed zone it may lie in.

    ``zones`` are the systems of the rasters (EPSG 326zz, 327zz). A point gets a window in
    those of its own hemisphere whose zone is its own or a neighbour's, as rasters reach
    over zone borders.
    """
    for zone in zones:
        utm_zone(zone)
    own = F.floor((F.col(lon) + 180) / 6).cast("int") % 60
    apart = lambda z: F.pmod(z % 100 - 1 - own, F.lit(60))
    south = F.col(lat) < 0
    near = F.filter(
        F.array(*[F.lit(z) for z in zones]), lambda z: apart(z).isin(0, 1, 59) & ((z >= 32700) == south)
    )
    placed = points.select("*", F.explode(near).alias("epsg"))
    x, y = to_zone(F.col(lat), F.col(lon), F.col("epsg"))
    half = size_m / 2.0
    centred = placed.select("*", x.alias("_cx"), y.alias("_cy"))
    return centred.select(
        *points.columns,
        (F.col("_cx") - half).alias("minx"),
        (F.col("_cy") - half).alias("miny"),
        (F.col("_cx") + half).alias("maxx"),
        (F.col("_cy") + half).alias("maxy"),
        "epsg",
    )


def pixel_centre(transform: Column, row: Column, col: Column) -> tuple[Column, Column]:
    """Centre of a pixel under the affine ``[a, b, c, d, e, f]``."""
    a, b, c, d, e, f = (F.get(transform, F.lit(i)) for i in range(6))
    u, v = col + 0.5, row + 0.5
    return a * u + b * v + c, d * u + e * v + f


def with_pixel_centres(df: DataFrame, transform: str = "transform") -> DataFrame:
    x, y = pixel_centre(F.col(transform), F.col("row"), F.col("col"))
    return df.withColumns({"x": x, "y": y})


def cell_of(value: Column, cell: float) -> Column:
    return F.floor(value / cell)
