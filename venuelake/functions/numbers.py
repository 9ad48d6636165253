"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_number(value: Column) -> Column:
    """Neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def first_number(*values: Column) -> Column:
    """The first value that is neither null nor NaN."""
    return F.coalesce(*[nan_to_null(v.cast("double")) for v in values])


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / whole.cast("double")


def relative_position(value: Column, low: Column, high: Column) -> Column:
    """Where ``value`` lies between ``low`` (0) and ``high`` (1); null when they are equal."""
    return F.when(high != low, 1 - (high - value) / (high - low))
