"""Distances and map projection as column expressions."""

from __future__ import annotations

from math import radians

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 ellipsoid, UTM scale and false easting, sphere radius for distances.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_SCALE = 0.9996
UTM_FALSE_EASTING = 500000.0
SPHERE_RADIUS_M = 6378140.0

_N = WGS84_F / (2 - WGS84_F)
_RADIUS = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_SERIES = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]
_ECCENTRICITY = (2 * WGS84_F - WGS84_F**2) ** 0.5


def zone_meridian(zone: int) -> float:
    """Central meridian of a UTM zone in degrees."""
    return zone * 6.0 - 183.0


def with_utm(
    df: DataFrame, latitude: Column, longitude: Column, x: str, y: str, zone: int = 31
) -> DataFrame:
    """Add northern-hemisphere UTM easting and northing in metres (Krüger series).

    Each step is a column of its own, so none is worked out more than once. The result
    comes out of a generator: filters on it, such as a join's test for nulls, would else be
    moved below the steps with the whole formula written out in them.
    """
    lat = F.radians(latitude)
    lon = F.radians(longitude) - F.lit(radians(zone_meridian(zone)))
    steps = df.withColumns({"_sin": F.sin(lat), "_lam": lon})
    conformal = F.sinh(F.atanh("_sin") - _ECCENTRICITY * F.atanh(_ECCENTRICITY * F.col("_sin")))
    steps = steps.withColumn("_tan", conformal)
    steps = steps.withColumns(
        {
            "_xi": F.atan2(F.col("_tan"), F.cos("_lam")),
            "_eta": F.atanh(F.sin("_lam") / F.sqrt(1 + F.col("_tan") * F.col("_tan"))),
        }
    )
    xi, eta = F.col("_xi"), F.col("_eta")
    east, north = eta, xi
    for order, factor in enumerate(_SERIES, start=1):
        east = east + factor * F.cos(2 * order * xi) * F.sinh(2 * order * eta)
        north = north + factor * F.sin(2 * order * xi) * F.cosh(2 * order * eta)
    scale = UTM_SCALE * _RADIUS
    point = F.struct((UTM_FALSE_EASTING + scale * east).alias(x), (scale * north).alias(y))
    return steps.select(*df.columns, F.inline(F.array(point)))


def distance_m(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, across1: Column | None = None, across2: Column | None = None
) -> Column:
    """Great-circle distance in metres between two points in degrees; ``across``: the latitudes' cosines, if known."""
    across1 = F.cos(F.radians(lat1)) if across1 is None else across1
    across2 = F.cos(F.radians(lat2)) if across2 is None else across2
    north, east = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = F.pow(north, 2) + across1 * across2 * F.pow(east, 2)
    return 2 * SPHERE_RADIUS_M * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
