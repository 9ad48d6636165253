"""Match points of two tables that lie within a radius of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake import schemas
from venuelake.functions.geo import with_utm
from venuelake.functions.numbers import nan_to_null
from venuelake.operators.skew import skew_join_both

# Grid cells are a few radii wide: a disc then touches little more than two cells on
# average, while a cell still holds few points.
CELL_RADII = 4


def _projected(df: DataFrame, lat: str, lon: str, zone: int, side: str) -> DataFrame:
    point = nan_to_null(F.col(lat)), nan_to_null(F.col(lon))
    return with_utm(df, *point, f"_{side}x", f"_{side}y", zone)


def within_radius(
    left: DataFrame,
    right: DataFrame,
    left_point: tuple[str, str] = ("latitude", "longitude"),
    right_point: tuple[str, str] = ("ta_latitude", "ta_longitude"),
    radius: float = schemas.MATCH_RADIUS_M,
    zone: int = 31,
    distance: str = "distance_m",
) -> DataFrame:
    """Pairs of rows less than ``radius`` projected metres apart, with their distance.

    Points meet through an equi-join on grid cells: a left point lies in one cell, a
    right one is sent to the cells its disc touches, so a pair meets once. Cells that
    hold a large share of the points are spread over several tasks.
    """
    side = CELL_RADII * radius
    a = _projected(left, *left_point, zone, "a").withColumns(
        {"_cx": F.floor(F.col("_ax") / side), "_cy": F.floor(F.col("_ay") / side)}
    )
    reach = lambda axis: F.sequence(
        F.floor((F.col(axis) - radius) / side), F.floor((F.col(axis) + radius) / side)
    )
    b = (
        _projected(right, *right_point, zone, "b")
        .withColumn("_cx", F.explode(reach("_bx")))
        .withColumn("_cy", F.explode(reach("_by")))
    )
    squared = (F.col("_ax") - F.col("_bx")) ** 2 + (F.col("_ay") - F.col("_by")) ** 2
    return (
        skew_join_both(a.where(F.col("_cx").isNotNull()), b, ["_cx", "_cy"])
        .where(squared < radius**2)
        .withColumn(distance, F.sqrt(squared))
        .drop("_cx", "_cy", "_ax", "_ay", "_bx", "_by")
    )


def within_radius_left(
    left: DataFrame, right: DataFrame, left_id: str,
    left_point: tuple[str, str] = ("latitude", "longitude"), **options: object,
) -> DataFrame:
    """Like :func:`within_radius`, but left rows without a partner stay, with nulls."""
    points = left.select(left_id, *left_point)
    pairs = within_radius(points, right, left_point=left_point, **options).drop(*left_point)
    return left.join(pairs, left_id, "left")
