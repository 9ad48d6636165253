"""Pairs within a radius and nearest places anywhere on the globe, without a map zone."""

from __future__ import annotations

from functools import reduce
from math import pi, sin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuelake.functions.geo import SPHERE_RADIUS_M, distance_m
from venuelake.functions.numbers import nan_to_null
from venuelake.operators.ranking import top_n
from venuelake.operators.skew import skew_join_both
from venuelake.session import durable

#: The side of a cell in chords: a left point then meets 2.8 times its partners, and a right one goes to 12.7 cells.
CELL_CHORDS = 1
#: Places that share a cell as wide as the first ring, for each one asked for; with more, the ring is drawn closer.
CROWD = 4
NEAREST_RING_M = 1.0
#: Half the way round: no two points are farther apart.
FARTHEST_M = pi * SPHERE_RADIUS_M
#: Metres by which a chord may be off for rounding; the test of pairs is by the distance itself.
SLACK_M = 1e-3


def _placed(df: DataFrame, lat: str, lon: str, side: str) -> DataFrame:
    """``df`` with earth-centred coordinates, latitude and longitude; rows without a point on the globe go.

    A spot has one longitude: 0 at the poles, elsewhere from -180 to less than 180. The columns come out of a generator, so that filters of a join cannot be moved below the formula.
    """
    latitude, longitude = nan_to_null(F.col(lat)), nan_to_null(F.col(lon))
    on_globe = df.where(latitude.between(-90, 90) & (F.abs(longitude) < float("inf")))
    turned = F.when(longitude.between(-180, 179.99999999999997), longitude).otherwise(F.pmod(longitude + 180, F.lit(360.0)) - 180)
    longitude = F.when(F.abs(latitude) == 90, F.lit(0.0)).otherwise(turned)
    across = F.cos(F.radians(latitude))
    point = F.struct(
        (SPHERE_RADIUS_M * across * F.cos(F.radians(longitude))).alias(f"_{side}x"),
        (SPHERE_RADIUS_M * across * F.sin(F.radians(longitude))).alias(f"_{side}y"),
        (SPHERE_RADIUS_M * F.sin(F.radians(latitude))).alias(f"_{side}z"),
        latitude.alias(f"_{side}lat"), longitude.alias(f"_{side}lon"), across.alias(f"_{side}across"),
    )
    return on_globe.select("*", F.inline(F.array(point)))


def _reach(axes: tuple[str, ...], side: float, chord: float) -> Column:
    """Whether the cell (_cx, _cy, _cz) holds a spot of the globe's surface within a chord of the right point."""
    total = lambda parts: reduce(lambda x, y: x + y, [p * p for p in parts])
    low = {n: F.col(f"_c{n}") * side for n in axes}
    high = {n: (F.col(f"_c{n}") + 1) * side for n in axes}
    none = F.lit(0.0)
    apart = total(F.greatest(none, low[n] - F.col(f"_b{n}"), F.col(f"_b{n}") - high[n]) for n in axes)
    inner = total(F.greatest(none, low[n], -high[n]) for n in axes)
    outer = total(F.greatest(F.abs(low[n]), F.abs(high[n])) for n in axes)
    return (
        (apart <= chord**2) & (inner <= (SPHERE_RADIUS_M + SLACK_M) ** 2) & (outer >= (SPHERE_RADIUS_M - SLACK_M) ** 2)
    )


def within_distance(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    left_point: tuple[str, str] = ("latitude", "longitude"),
    right_point: tuple[str, str] = ("ta_latitude", "ta_longitude"),
    distance: str = "distance_m",
) -> DataFrame:
    """Pairs of rows less than ``radius`` metres apart along the great circle, with their distance.

    Points are given in degrees and may lie on both sides of the date line and around the poles. They meet in
    an equi-join on cells of a grid in space, a chord wide: a left point lies in one cell, a right one is sent
    to those of the surface within a chord of it, so a pair meets once. Cells with a large share of the points,
    or that make too many pairs, are spread over several tasks. Rows without a point, with null, NaN or infinite
    degrees or a latitude beyond the poles, have no partner. All other column names of the two sides must differ.
    """
    chord = 2 * SPHERE_RADIUS_M * sin(min(radius / (2 * SPHERE_RADIUS_M), pi / 2)) + SLACK_M
    side = CELL_CHORDS * chord
    axes = ("x", "y", "z")
    a = _placed(left, *left_point, "a").withColumns({f"_c{n}": F.floor(F.col(f"_a{n}") / side) for n in axes})
    b = _placed(right, *right_point, "b")
    for n in axes:
        at = F.col(f"_b{n}")
        b = b.withColumn(f"_c{n}", F.explode(F.sequence(F.floor((at - chord) / side), F.floor((at + chord) / side))))
    b = b.where(_reach(axes, side, chord))
    apart = [F.col(f"_a{n}") - F.col(f"_b{n}") for n in axes]
    squared = reduce(lambda x, y: x + y, [d * d for d in apart])
    metres = distance_m(*(F.col(f"_{s}{n}") for s in "ab" for n in ("lat", "lon")), F.col("_aacross"), F.col("_bacross"))
    # Only where rounding can decide is the distance itself asked for.
    certain = squared < max(0.0, chord - 2 * SLACK_M) ** 2
    helpers = [*(f"_{s}{n}" for s in "abc" for n in axes), *(f"_{s}{n}" for s in "ab" for n in ("lat", "lon", "across"))]
    return (
        skew_join_both(a, b, [f"_c{n}" for n in axes], hint="merge")
        .where((squared < chord**2) & (certain | (metres < radius)))
        .withColumn(distance, metres)
        .drop(*helpers)
    )


def _first_ring(places: DataFrame, point: tuple[str, str], k: int, widest: float, growth: float) -> float:
    """The first ring's radius: so small that a place shares its cell with ``CROWD * k`` places at most, on average."""
    radius = min(widest, FARTHEST_M)
    while radius > NEAREST_RING_M:
        cells = _placed(places, *point, "b").groupBy(*(F.floor(F.col(f"_b{n}") / radius) for n in "xyz")).count()
        around = cells.agg(F.sum(F.col("count").cast("double") ** 2) / F.sum("count")).first()[0]
        if around is None or around <= CROWD * k:
            break
        radius /= growth
    return radius


def nearest_places(
    left: DataFrame,
    right: DataFrame,
    k: int,
    left_id: str,
    right_id: str,
    left_point: tuple[str, str] = ("latitude", "longitude"),
    right_point: tuple[str, str] = ("ta_latitude", "ta_longitude"),
    start: float = 1000.0,
    growth: float = 3.0,
    distance: str = "distance_m",
) -> DataFrame:
    """The ``k`` right rows nearest to each left row: (left_id, rank, right_id, distance), ties to the smaller id.

    Rings grow around the left points: who finds ``k`` places nearer than ``start`` metres, or less if places stand
    close, is done, the others look ``growth`` times as far, until everyone is done or the whole globe has been searched, after at most
    log(20,000 km / start) / log(growth) rounds. So no left row meets all places unless fewer than ``k`` lie in all
    smaller rings. Of places on one spot only the ``k`` smallest ids take part. ``left_id`` must be unique;
    left rows without a point have no result, and all have fewer than ``k`` if there are fewer places.
    """
    points = left.select(left_id, *left_point)
    spots = durable(top_n(right.select(right_id, *right_point), [*right_point], [right_id], k, "_of_spot").drop("_of_spot"))
    searching, found, radius = durable(points), [], _first_ring(spots, right_point, k, start, growth)
    while True:
        whole = radius >= FARTHEST_M
        pairs = within_distance(
            searching, spots, 2 * FARTHEST_M if whole else radius, left_point, right_point, distance
        ).select(left_id, right_id, distance)
        near = durable(top_n(pairs, [left_id], [distance, right_id], k, "rank"))
        full = near.where(F.col("rank") == k).select(left_id)
        if whole:
            found.append(near)
            break
        found.append(near.join(full, left_id, "left_semi"))
        searching = durable(searching.join(full, left_id, "left_anti"))
        if searching.isEmpty():
            break
        radius *= growth
    return reduce(DataFrame.union, found).select(left_id, F.col("rank").cast("long").alias("rank"), right_id, distance)
